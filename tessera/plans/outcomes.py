"""What batches of fetches, recoveries and completions do to whole product rows, as if applied one after the other.

A batch may hold a product more than once, under its own slug or as where another one led; `ordinal` gives the order. The rows of
one slug are folded to what the last of them leaves, so nothing is applied in a loop and nothing is doubled.

A fetched result replaces the copy of a known product. One that ended at another slug is that product's: it is added if need be, the product asked for goes, and its slug
becomes an alias. Any other result changes the status of a known product. Fetched rows have no retry time and no error left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.merge import fold, insert_missing, merge

#: The columns of a product that a fetched page gives.
PAGE = ("product_url", "name", "tagline", "description", "website_url", "categories", "content_hash")
STATE = ("status", "http_status", "next_retry_at", "last_error")


def _last(rows: DataFrame, key: str, order: str, others: list[str]) -> DataFrame:
    """Of every key the row that is last in order."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r")).select(key, "r.*")


def apply_fetches(products: DataFrame, aliases: DataFrame, results: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(products, aliases) after results: slug, final_slug, outcome, attempt, http_status, error, retry_at, PAGE, ordinal.

    products: slug, STATE, PAGE, attempts, fetched_at and any others; aliases: alias_slug, canonical_slug, http_status.
    """
    got = F.col("outcome") == "fetched"
    moved = got & (F.col("final_slug") != F.col("slug"))
    state = F.struct(
        F.when(got, "fetched").otherwise(F.col("outcome")).alias("status"), F.col("http_status"), F.when(~got, F.col("retry_at")).alias("next_retry_at"), F.when(~got, F.col("error")).alias("last_error")
    )
    page = F.when(got, F.struct(*PAGE))
    put = results.select(F.when(moved, F.col("final_slug")).otherwise(F.col("slug")).alias("slug"), F.when(moved, "put").otherwise("change").alias("what"), "ordinal", "attempt", state.alias("state"), page.alias("page"))
    gone = results.where(moved).select("slug", F.lit("drop").alias("what"), "ordinal")
    events = put.unionByName(gone, allowMissingColumns=True)
    # a slug's row lives on from its old one, or from the first result that puts it anew after the last that drops it
    of_slug = Window.partitionBy("slug")
    events = events.join(products.select("slug", F.lit(True).alias("_known")), "slug", "left")
    events = events.withColumn("_dropped", F.max(F.when(F.col("what") == "drop", F.col("ordinal"))).over(of_slug))
    events = events.withColumn("_born", F.min(F.when((F.col("what") == "put") & (F.col("_dropped").isNull() | (F.col("ordinal") > F.col("_dropped"))), F.col("ordinal"))).over(of_slug))
    old = F.col("_known") & F.col("_dropped").isNull()
    live = F.coalesce(old, F.lit(False)) | (F.col("ordinal") >= F.col("_born"))
    live = F.coalesce(live, F.lit(False)) & (F.col("what") != "drop")
    sums = events.groupBy("slug").agg(
        F.max_by("state", F.when(live, F.col("ordinal"))).alias("_state"), F.max_by("page", F.when(live & F.col("page").isNotNull(), F.col("ordinal"))).alias("_page"), F.bool_or(live & F.col("page").isNotNull()).alias("_copied"),
        F.max(F.when(live & (F.col("what") == "put"), F.col("attempt"))).alias("_attempt"), F.bool_or(live).alias("_live"), F.bool_or(F.col("_dropped").isNotNull()).alias("_new"),
    )
    both = products.withColumn("_old", F.lit(True)).join(sums.withColumnRenamed("slug", "_slug"), F.col("slug") == F.col("_slug"), "full_outer")
    both = both.where(F.col("_slug").isNull() | F.col("_live"))
    kept = F.col("_old") & ~F.coalesce("_new", F.lit(False))  # values of a row that was dropped and put anew don't come back
    touched = F.col("_slug").isNotNull()

    def value(c: str) -> Column:
        was = F.when(kept, F.col(c))
        if c == "slug":
            return F.coalesce("slug", "_slug")
        if c in STATE:
            return F.when(touched, F.col("_state")[c]).otherwise(was)
        if c in PAGE:
            return F.when(F.coalesce("_copied", F.lit(False)), F.col("_page")[c]).otherwise(was)
        if c == "attempts":
            return F.coalesce(F.greatest(was, F.col("_attempt")), F.lit(0)).cast(products.schema[c].dataType)
        if c == "fetched_at":
            return F.when(F.coalesce("_copied", F.lit(False)), now).otherwise(was)
        return was

    rows = both.select(*(value(c).alias(c) for c in products.columns))
    links = _last(results.where(moved).withColumns({"alias_slug": F.col("slug"), "canonical_slug": F.col("final_slug")}), "alias_slug", "ordinal", ["canonical_slug", "http_status"])
    return rows, merge(aliases, links, "alias_slug", {"canonical_slug": "last", "http_status": "last"}).select(*aliases.columns)


def _recovered(recoveries: DataFrame, results: DataFrame, key: str, others: tuple[str, ...]) -> DataFrame:
    """Recoveries with the last result of each key and the most attempts; nulls of a result count."""
    rows = _last(results.withColumn("last_error", F.col("error")), key, "ordinal", ["outcome", "capture_timestamp", "http_status", "last_error", *others])
    tries = results.groupBy(key).agg(F.max("attempt").alias("attempts"))
    rules = dict.fromkeys(("outcome", "capture_timestamp", "http_status", "last_error", *others), "last")
    return merge(recoveries, rows.join(tries, key), key, rules | {"attempts": "max"}).select(*recoveries.columns)


def apply_recoveries(products: DataFrame, aliases: DataFrame, recoveries: DataFrame, results: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, aliases, recoveries) after results as those of `apply_fetches`, with capture_timestamp: recovered ones are applied as fetched pages are."""
    done = results.where("outcome = 'recovered'").withColumns({"outcome": F.lit("fetched"), "retry_at": F.lit(None).cast(products.schema["next_retry_at"].dataType)})
    rows, links = apply_fetches(products, aliases, done, now)
    return rows, links, _recovered(recoveries, results, "slug", ())


def apply_post_recoveries(products: DataFrame, aliases: DataFrame, resolutions: DataFrame, recoveries: DataFrame, results: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(products, resolutions, recoveries, how many more products are fetched) after results: post_slug, slug, outcome, attempt, http_status, error, capture_timestamp, PAGE, ordinal.

    A recovered launch whose product is an alias is resolved to the canonical one. Else its product is added, and filled by the first result that finds it unfetched. A
    result that isn't recovered keeps the slug that it came with.
    """
    canonical = aliases.select(F.col("alias_slug").alias("slug"), F.col("canonical_slug").alias("_to"))
    good = F.col("outcome") == "recovered"
    found = results.join(canonical, "slug", "left").withColumn("product_slug", F.when(good, F.coalesce("_to", "slug")).otherwise(F.col("slug")))
    mine = found.where(good & F.col("_to").isNull())
    blank = insert_missing(products, mine.select("slug").distinct(), "slug").withColumns({"status": F.lit("pending"), "attempts": F.lit(0).cast(products.schema["attempts"].dataType)})
    every = products.unionByName(blank, allowMissingColumns=True)
    first = mine.groupBy("slug").agg(F.min_by(F.struct("attempt", "http_status", *PAGE, "ordinal"), "ordinal").alias("r")).select("slug", "r.*")
    first = first.join(every.where("status = 'fetched'").select("slug"), "slug", "left_anti")
    none = F.lit(None).cast(products.schema["next_retry_at"].dataType)
    fills = first.withColumns({"final_slug": F.col("slug"), "outcome": F.lit("fetched"), "error": F.lit(None).cast("string"), "retry_at": none})
    rows, _ = apply_fetches(every, aliases, fills, now)
    solved = _last(found.where(good).select("post_slug", F.col("product_slug").alias("_to"), "ordinal"), "post_slug", "ordinal", ["_to"])
    hit = F.col("_to").isNotNull()
    after = resolutions.join(solved, "post_slug", "left").withColumns({"product_slug": F.when(hit, F.col("_to")).otherwise(F.col("product_slug")), "outcome": F.when(hit, "resolved").otherwise(F.col("outcome"))})
    return rows, after.select(*resolutions.columns), _recovered(recoveries, found, "post_slug", ("product_slug",)), fills.count()


def apply_completions(products: DataFrame, records: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(products, one row with the number of newly fetched ones) after records: slug, PAGE without product_url, ordinal.

    Records with name, description and a tagline or web site fill known products: for every column the last record that sets it, categories the last that has some, and
    the hash of the last. The page counts as fetched with status 200.
    """
    whole = F.col("name").isNotNull() & F.col("description").isNotNull() & (F.col("tagline").isNotNull() | F.col("website_url").isNotNull())
    some = records.where(whole).withColumn("categories", F.when(F.size("categories") > 0, F.col("categories")))
    rules = dict.fromkeys(("name", "tagline", "description", "website_url", "categories"), "last_set") | {"content_hash": "last"}
    new = fold(some, "slug", rules, "ordinal").select(F.col("slug").alias("_slug"), *(F.col(c).alias(f"_{c}") for c in rules))
    both = products.join(new, F.col("slug") == F.col("_slug"), "left")
    hit = F.col("_slug").isNotNull()
    changes = {c: F.coalesce(f"_{c}", c) for c in rules if c != "content_hash"}
    changes |= {"content_hash": F.when(hit, F.col("_content_hash")).otherwise(F.col("content_hash")), "http_status": F.when(hit, 200).otherwise(F.col("http_status")), "fetched_at": F.when(hit, now).otherwise(F.col("fetched_at"))}
    changes |= {c: F.when(~hit, F.col(c)) for c in ("next_retry_at", "last_error")} | {"status": F.when(hit, "fetched").otherwise(F.col("status"))}
    fresh = both.agg(F.count_if(hit & (F.col("status") != "fetched")).alias("newly_fetched"))
    return both.withColumns(changes).select(*products.columns), fresh
