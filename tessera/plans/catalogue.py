"""The catalogue's transactions as functions from tables and a batch to new tables.

Where a scan has a cursor, the caller states the position it read; a batch for another position is refused, so a
replay changes nothing. Time is a parameter, one literal for a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import blank, sql_content_hash
from tessera.operators.merge import fold, insert_missing, merge
from tessera.plans.store import CursorChanged

COPY = ("name", "tagline", "description", "website_url")


def import_products(products: DataFrame, aliases: DataFrame, excluded: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, inserted): slugs of a site map that are no aliases and not excluded, with their latest change.

    batch: slug, lastmod. A slug may come more than once.
    """
    latest = batch.groupBy("slug").agg(F.max("lastmod").alias("source_lastmod"))
    fresh = insert_missing(aliases.select(F.col("alias_slug").alias("slug")), latest, "slug", excluded)
    inserted = insert_missing(products, fresh, "slug")
    merged = merge(products, fresh, "slug", {"source_lastmod": "max"})
    return merged.withColumns({"status": F.coalesce("status", F.lit("pending")), "attempts": F.coalesce("attempts", F.lit(0))}), inserted


def checked_cursor(scans: DataFrame, key: str, name: str, column: str, expected: int) -> None:
    """Refuse a batch that doesn't begin where the scan stands."""
    row = scans.where(F.col(key) == name).select(column).first()
    if row is None or row[0] != expected:
        raise CursorChanged(f"cursor changed: {name} is at {row and row[0]}, not {expected}")


def checked_cursors(scans: DataFrame, pages: DataFrame, key: str, expected: str, stored: str) -> None:
    """The same for many cursors: every page of the batch must be its scan's next one."""
    wrong = pages.select(key, expected).distinct().join(scans.select(key, stored), key, "left").where(F.col(stored).isNull() | (F.col(stored) != F.col(expected))).count()
    if wrong:
        raise CursorChanged(f"cursor changed: {wrong} scans stand elsewhere")


def advanced(scans: DataFrame, steps: DataFrame, key: str, position: str) -> DataFrame:
    """Scans moved on by one row a key: position, and counters requests, discovered and unavailable where they are."""
    counters = {c: "sum" for c in ("requests", "discovered", "unavailable", "pages_scanned") if c in steps.columns}
    return merge(scans, steps, key, {position: "max"} | counters)


def apply_catalogue_batch(products: DataFrame, source_ids: DataFrame, aliases: DataFrame, records: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(products, source ids) after records (product_id, slug, fields, ordinal) of an id scan.

    New values win where they are set; a fetched product stays fetched, and a record that is complete makes it so.
    """
    ids = fold(records.withColumns({"first_seen_at": now, "last_seen_at": now}), "product_id", {"slug": "last", "first_seen_at": "min", "last_seen_at": "max"}, "ordinal")
    ids = merge(source_ids, ids, "product_id", {"slug": "last", "first_seen_at": "min", "last_seen_at": "max"})
    rules = {c: "last_set" for c in COPY}
    rows = insert_missing(aliases.select(F.col("alias_slug").alias("slug")), fold(records, "slug", rules, "ordinal"), "slug")
    merged = merge(products, rows, "slug", rules)
    whole = F.col("name").isNotNull() & F.col("description").isNotNull() & (F.col("tagline").isNotNull() | F.col("website_url").isNotNull())
    seen = rows.select("slug", F.lit(True).alias("_seen"))
    status = F.when((F.col("status") == "fetched") | (F.col("_seen") & whole), "fetched").otherwise(F.coalesce("status", F.lit("pending")))
    return merged.join(seen, "slug", "left").withColumn("status", status).drop("_seen"), ids


def resolutions(current: DataFrame, batch: DataFrame, upgrade: bool) -> DataFrame:
    """Launch resolutions (post_slug, post_id, product_id, product_slug, outcome).

    The first write wins, by an ordinal where the batch has one and may repeat a launch; with `upgrade` a resolved row replaces one that isn't, never the other way, and the
    first known post_id stays.
    """
    if not upgrade:
        first = fold(batch, "post_slug", {c: "first" for c in batch.columns if c not in ("post_slug", "ordinal")}, "ordinal") if "ordinal" in batch.columns else batch
        return current.unionByName(insert_missing(current, first, "post_slug"))
    new = batch.select("post_slug", *(F.col(c).alias(f"_n_{c}") for c in ("post_id", "product_id", "product_slug", "outcome")))
    both = current.join(new, "post_slug", "full_outer")
    better = F.col("outcome").isNull() | ((F.col("_n_outcome") == "resolved") & (F.col("outcome") != "resolved"))
    pick = lambda c: F.when(better, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)
    return both.select("post_slug", F.coalesce("post_id", "_n_post_id").alias("post_id"), pick("product_id"), pick("product_slug"), pick("outcome"))


def memberships(current: DataFrame, found: DataFrame, source_ids: DataFrame, keys: list[str], now: Column) -> tuple[DataFrame, int]:
    """(candidates, new ids): products seen in searches, categories or collections.

    An id that the id scan doesn't know is new, and stays marked as new.
    """
    known = source_ids.select("product_id", F.lit(False).alias("new_product_id"))
    rows = found.dropDuplicates(keys).join(known, "product_id", "left").withColumn("new_product_id", F.coalesce("new_product_id", F.lit(True)))
    fresh = rows.join(current.select(*keys), keys, "left_anti").where("new_product_id").select("product_id").distinct().count()
    key = F.concat_ws("\x1f", *keys)
    new = rows.withColumns({"_key": key, "first_seen_at": now, "last_seen_at": now})
    others = [c for c in found.columns if c not in keys]
    rules = {c: "keep" for c in keys} | {c: "last_set" for c in others} | {"new_product_id": "any", "first_seen_at": "min", "last_seen_at": "max"}
    return merge(current.withColumn("_key", key), new, "_key", rules).drop("_key"), fresh


def overflow_position(count: Column, offset: Column, page: int = 100) -> Column:
    return F.least(count, offset + page)


def stage_external(current: DataFrame, rows: DataFrame, source: str) -> DataFrame:
    """Staged rows of other catalogues: values fill gaps, the first source stays; rows carry an ordinal."""
    rules = {c: "first_set" for c in (*COPY, "product_id", "source")}
    tagged = rows.withColumns({"source": F.lit(source), "description": F.coalesce(F.nullif("description", F.lit("")), "tagline")})
    return merge(current, fold(tagged, "slug", rules, "ordinal"), "slug", rules)


def known_aliases(aliases: DataFrame, products: DataFrame, batch: DataFrame) -> DataFrame:
    """Aliases whose canonical product exists, added or moved."""
    valid = batch.join(products.select(F.col("slug").alias("canonical_slug")), "canonical_slug", "left_semi").where("alias_slug <> canonical_slug")
    rules = {"canonical_slug": "last"}
    return merge(aliases, fold(valid, "alias_slug", rules, "ordinal"), "alias_slug", rules)


def enriched(products: DataFrame, found: DataFrame) -> DataFrame:
    """Web-site copy fills fields that are still empty, marked with where it came from, and the hash is made anew.

    found: slug, tagline, tagline_origin, description, description_origin.
    """
    new = found.select("slug", *(F.col(c).alias(f"_n_{c}") for c in ("tagline", "tagline_origin", "description", "description_origin")))
    both = products.join(new, "slug", "left")
    changes: dict[str, Column] = {}
    for c in ("tagline", "description"):
        fill = blank(F.col(c)) & ~blank(F.col(f"_n_{c}"))
        changes[c] = F.when(fill, F.col(f"_n_{c}")).otherwise(F.col(c))
        changes[f"{c}_source"] = F.when(fill, F.concat(F.lit("website:"), F.col(f"_n_{c}_origin"))).otherwise(F.col(f"{c}_source"))
    out = both.withColumns(changes)
    touched = ~(F.col("tagline").eqNullSafe(F.col("_o_tagline")) & F.col("description").eqNullSafe(F.col("_o_description")))
    old = products.select("slug", F.col("tagline").alias("_o_tagline"), F.col("description").alias("_o_description"))
    digest = sql_content_hash([F.col("slug"), *(F.col(c) for c in COPY)], F.coalesce("categories", F.array().cast("array<string>")))
    return out.join(old, "slug").withColumn("content_hash", F.when(touched, digest).otherwise(F.col("content_hash"))).select(*products.columns)


def apply_results(products: DataFrame, aliases: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, aliases, errors) after fetch results (slug, final_slug, outcome, http_status, error, copy fields, ordinal).

    A result that ended at another slug is that product's; the requested one becomes its alias. Other results
    update the requested product; those with an error are appended to the errors.
    """
    moved = results.where((F.col("outcome") == "fetched") & (F.col("final_slug") != F.col("slug")))
    updates = results.withColumn("slug", F.when(F.col("outcome") == "fetched", F.col("final_slug")).otherwise(F.col("slug")))
    rules = {"outcome": "last", "http_status": "last"} | {c: "last_set" for c in COPY}
    rows = fold(updates, "slug", rules, "ordinal").withColumnRenamed("outcome", "status")
    merged = merge(products.join(moved.select("slug"), "slug", "left_anti"), rows, "slug", {"status": "last", "http_status": "last"} | {c: "last_set" for c in COPY})
    alias = fold(moved.select(F.col("slug").alias("alias_slug"), F.col("final_slug").alias("canonical_slug"), "ordinal"), "alias_slug", {"canonical_slug": "last"}, "ordinal")
    errors = results.where("error is not null").select("slug", "http_status", "error")
    return merged, merge(aliases, alias, "alias_slug", {"canonical_slug": "last"}), errors


def capture_scan(current: DataFrame, found: DataFrame) -> DataFrame:
    """Captures (slug, crawl_id, capture_timestamp, ...) of a scan: recovered ones stay so, others are pending again."""
    keys = ["slug", "crawl_id"]
    others = [c for c in found.columns if c not in keys]
    new = found.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in others), F.lit(True).alias("_new"))
    both = current.join(new, keys, "full_outer")
    done = F.coalesce(F.col("outcome") == "recovered", F.lit(False))
    fresh = F.col("_new") & ~done
    return both.select(
        *keys, *(F.when(fresh, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in others),
        F.when(fresh, "pending").otherwise(F.col("outcome")).alias("outcome"), F.when(fresh, 0).otherwise(F.col("attempts")).alias("attempts"),
    )


def counts_by(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value of a state column."""
    return rows.groupBy(F.col(column).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """For each key: how many of its values are held by more than one row."""
    out = None
    for key in keys:
        one = rows.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit(key).alias("key"), "n")
        out = one if out is None else out.unionByName(one)
    return out
