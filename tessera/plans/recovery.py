"""Recovery of lost products from archives, pending queues, the run log and the status report.

As in `catalogue`, every transaction takes the current tables and a batch and gives the new tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import blank, sql_content_hash
from tessera.operators.merge import fold, insert_missing, merge
from tessera.plans.catalogue import COPY, apply_results

#: Forms of slugs, outcomes of a recovery that may be claimed again, outcomes of a capture.
RECOVERABLE_SLUG = "^[a-z0-9]([a-z0-9._-]*[a-z0-9])?$"
POST_SLUG, NUMBER = "^[a-z0-9][a-z0-9_-]*$", "^[0-9]+$"
OPEN = ("claimed", "retry")
CAPTURE_OUTCOMES = ("recovered", "parse_failed", "fetch_failed")


def _next_attempts(rows: DataFrame, recoveries: DataFrame, key: str, most_attempts: int, limit: int) -> DataFrame:
    """(key, attempt) of the first rows in order of their key whose recovery may be tried (again)."""
    known = recoveries.select(F.col(key).alias("_k"), F.col("attempts").alias("_a"), F.col("outcome").alias("_o"))
    tried = F.coalesce("_a", F.lit(0))
    due = rows.join(known, F.col(key) == F.col("_k"), "left").where((tried < most_attempts) & (F.col("_k").isNull() | F.col("_o").isin(*OPEN)))
    return due.orderBy(key).limit(limit).select(key, (tried + 1).cast("long").alias("attempt"))


def claim_recoveries(products: DataFrame, recoveries: DataFrame, most_attempts: int, limit: int) -> DataFrame:
    """(slug, attempt): unavailable products to look for in archives."""
    rows = products.where("status = 'unavailable'").where(F.col("slug").rlike(RECOVERABLE_SLUG)).select("slug")
    return _next_attempts(rows, recoveries, "slug", most_attempts, limit)


def claim_post_recoveries(candidates: DataFrame, resolutions: DataFrame, recoveries: DataFrame, most_attempts: int, limit: int) -> DataFrame:
    """(post_slug, attempt): archived launches that are resolved as unavailable; numbers are no launch slugs."""
    lost = resolutions.where("outcome = 'unavailable'").select("post_slug")
    rows = candidates.where("path_kind = 'posts'").select(F.col("slug").alias("post_slug")).join(lost, "post_slug", "left_semi")
    rows = rows.where(F.col("post_slug").rlike(POST_SLUG) & ~F.col("post_slug").rlike(NUMBER))
    return _next_attempts(rows, recoveries, "post_slug", most_attempts, limit)


def claimed(recoveries: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """The recoveries after claims (key, attempt): claimed, counted, their error gone."""
    rows = claims.select(key, F.lit("claimed").alias("outcome"), F.col("attempt").alias("attempts"), F.lit(None).cast("string").alias("last_error"))
    return merge(recoveries, rows, key, {"outcome": "last", "attempts": "last", "last_error": "last"})


def _outcomes(recoveries: DataFrame, results: DataFrame, key: str, others: tuple[str, ...]) -> DataFrame:
    rules = {"outcome": "last", "attempts": "max", "http_status": "last", "last_error": "last"} | {c: "last" for c in others}
    rows = results.withColumns({"attempts": F.col("attempt"), "last_error": F.col("error")})
    return merge(recoveries, fold(rows, key, rules, "ordinal"), key, rules)


def apply_recoveries(products: DataFrame, aliases: DataFrame, recoveries: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, aliases, recoveries) after results (slug, final_slug, outcome, attempt, http_status, error, copy fields, ordinal).

    A recovered row is applied as a fetched page is; every result gives its recovery's outcome.
    """
    done = results.where("outcome = 'recovered'").withColumns({"outcome": F.lit("fetched"), "error": F.lit(None).cast("string")})
    rows, known, _ = apply_results(products, aliases, done)
    return rows, known, _outcomes(recoveries, results, "slug", ())


def apply_post_recoveries(products: DataFrame, aliases: DataFrame, resolutions: DataFrame, recoveries: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, resolutions, recoveries) after results (post_slug, slug, outcome, attempt, http_status, error, copy fields, ordinal).

    A recovered launch whose product is an alias is resolved to the canonical one; else its product is added, and
    filled unless it is fetched already, by the first result.
    """
    canonical = aliases.select(F.col("alias_slug").alias("_a"), F.col("canonical_slug").alias("_c"))
    found = results.join(canonical, F.col("slug") == F.col("_a"), "left").withColumn("product_slug", F.coalesce("_c", "slug"))
    fetched = products.where("status = 'fetched'").select("slug")
    new = found.where("outcome = 'recovered' and _a is null").join(fetched, "slug", "left_anti")
    new = new.withColumn("_backwards", -F.col("ordinal"))
    rules = {"http_status": "last"} | {c: "last" for c in COPY}
    rows = fold(new, "slug", rules, "_backwards").withColumn("status", F.lit("fetched"))
    rules = {"status": "last", "http_status": "last"} | {c: "last_set" for c in COPY}
    solved = fold(found.where("outcome = 'recovered'").withColumn("_to", F.col("product_slug")), "post_slug", {"_to": "last"}, "ordinal")
    after = resolutions.join(solved.select(F.col("post_slug").alias("_p"), "_to"), F.col("post_slug") == F.col("_p"), "left")
    after = after.withColumns({"product_slug": F.when(F.col("_p").isNotNull(), F.col("_to")).otherwise(F.col("product_slug")), "outcome": F.when(F.col("_p").isNotNull(), "resolved").otherwise(F.col("outcome"))})
    return merge(products, rows, "slug", rules), after.select(*resolutions.columns), _outcomes(recoveries, found, "post_slug", ("product_slug",))


def capture_outcomes(captures: DataFrame, changes: DataFrame, keys: tuple[str, ...] = ("slug", "crawl_id")) -> DataFrame:
    """Captures with the outcome, attempt, http_status and error of the changes (keys, outcome, attempt, http_status, error).

    An outcome other than CAPTURE_OUTCOMES is an error; changes of unknown captures do nothing. Of changes of one capture the last by `ordinal` counts, where
    the batch has one, else the one with the most attempts.
    """
    order = F.struct("ordinal") if "ordinal" in changes.columns else F.struct("attempt", "outcome")
    names = [c for c in changes.columns if c not in keys]
    changes = changes.groupBy(*keys).agg(F.max_by(F.struct(*names), order).alias("_r")).select(*keys, "_r.*")
    wrong = F.raise_error(F.concat(F.lit("no outcome of a capture: "), F.coalesce("outcome", F.lit("null")))).cast("string")
    checked = F.when(F.col("outcome").isin(*CAPTURE_OUTCOMES), F.col("outcome")).otherwise(wrong)
    new = changes.select(*keys, checked.alias("_outcome"), F.col("attempt").alias("_attempts"), F.col("http_status").alias("_http_status"), F.col("error").alias("_last_error"), F.lit(True).alias("_hit"))
    both = captures.join(new, list(keys), "left")
    return both.select(*(F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("outcome", "attempts", "http_status", "last_error") else c for c in captures.columns))


def _unresolved_posts(candidates: DataFrame, resolutions: DataFrame) -> DataFrame:
    rows = candidates.where("path_kind = 'posts'").select("slug")
    return rows.join(resolutions.select(F.col("post_slug").alias("slug")), "slug", "left_anti")


def pending_posts(candidates: DataFrame, source_ids: DataFrame, resolutions: DataFrame, limit: int) -> DataFrame:
    """Archived launch slugs to resolve: of the right form, and no known product's slug unless they are numbers."""
    known = source_ids.select("slug", F.lit(True).alias("_known")).distinct()
    rows = _unresolved_posts(candidates, resolutions).join(known, "slug", "left")
    return rows.where((F.col("_known").isNull() | F.col("slug").rlike(NUMBER)) & F.col("slug").rlike(POST_SLUG)).select("slug").orderBy("slug").limit(limit)


def bad_posts(candidates: DataFrame, source_ids: DataFrame, resolutions: DataFrame) -> DataFrame:
    """The resolutions with archived slugs of a wrong form as unavailable."""
    rows = _unresolved_posts(candidates, resolutions).join(source_ids.select("slug"), "slug", "left_anti").where(~F.col("slug").rlike(POST_SLUG))
    rows = rows.select(F.col("slug").alias("post_slug"), F.lit("unavailable").alias("outcome")).distinct()
    return resolutions.unionByName(rows, allowMissingColumns=True)


def pending_archive_products(products: DataFrame, candidates: DataFrame, limit: int) -> DataFrame:
    """Archived product slugs that wait to be fetched."""
    seen = candidates.where("path_kind = 'products'").select("slug")
    return products.where("status in ('pending', 'retry')").join(seen, "slug", "left_semi").select("slug").orderBy("slug").limit(limit)


def pending_ids(source_ids: DataFrame, products: DataFrame, after: int, limit: int) -> DataFrame:
    """The next ids, in order, of products that aren't fetched."""
    open_ = products.where("status <> 'fetched'").select("slug")
    return source_ids.where(F.col("product_id") > after).join(open_, "slug", "left_semi").select("product_id").orderBy("product_id").limit(limit)


def scan_complete(scans: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The wanted scans with whether they are done."""
    return wanted.join(scans.select(*keys, F.lit(True).alias("_done")).distinct(), keys, "left").withColumn("complete", F.coalesce("_done", F.lit(False))).drop("_done")


def archive_scan(candidates: DataFrame, products: DataFrame, aliases: DataFrame, scans: DataFrame, found: DataFrame, scan: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates, products, scans) after one index's found slugs (path_kind, slug).

    Known candidates are seen again; product slugs that are no aliases become pending products; the scan's row
    (index_id, path_kind, captures, malformed_lines) is kept once, with its number of slugs.
    """
    rows = found.distinct()
    key = F.concat_ws("\x1f", "path_kind", "slug")
    rules = {"path_kind": "keep", "slug": "keep", "first_seen_at": "min", "last_seen_at": "max"}
    seen = merge(candidates.withColumn("_key", key), rows.withColumns({"_key": key, "first_seen_at": now, "last_seen_at": now}), "_key", rules).drop("_key")
    fresh = insert_missing(products, rows.where("path_kind = 'products'").select("slug"), "slug", aliases.select(F.col("alias_slug").alias("slug")))
    added = products.unionByName(fresh.withColumns({"status": F.lit("pending"), "attempts": F.lit(0).cast("long")}), allowMissingColumns=True)
    sizes = rows.groupBy("path_kind").agg(F.count(F.lit(1)).alias("unique_candidates"))
    new = scan.join(scans.select("index_id", "path_kind"), ["index_id", "path_kind"], "left_anti").join(sizes, "path_kind", "left")
    return seen, added, scans.unionByName(new.withColumn("unique_candidates", F.coalesce("unique_candidates", F.lit(0)).cast("long")).select(*scans.columns))


def resumed(scans: DataFrame, batch: DataFrame) -> DataFrame:
    """Scans by resume key after pages (path_kind, captures, next_resume_key): without a next key they are complete.

    Pages of one scan count in the order of `ordinal`, which a batch with several of them has.
    """
    order = F.col("ordinal") if "ordinal" in batch.columns else F.lit(0)
    sums = batch.groupBy("path_kind").agg(F.max_by(F.struct("next_resume_key"), order).alias("_r"), F.sum("captures").alias("_captures"), F.count(F.lit(1)).alias("_pages"), F.lit(True).alias("_hit"))
    both = scans.join(sums.withColumn("_next", F.col("_r.next_resume_key")), "path_kind", "left")
    put = lambda c, x: F.when(F.col("_hit"), x).otherwise(F.col(c)).alias(c)
    return both.select("path_kind", put("resume_key", F.col("_next")), put("requests", F.col("requests") + F.col("_pages")), put("captures", F.col("captures") + F.col("_captures")), put("complete", F.col("_next").isNull()))


def product_resolutions(products: DataFrame, aliases: DataFrame, source_ids: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(products, aliases, source ids) after lookups by slug (slug, product_id, final_slug, copy fields, ordinal).

    A lookup without an id makes the product unavailable; another gives it its id and is applied as a fetched page.
    """
    got = F.col("product_id").isNotNull()
    error = F.when(~got, F.lit("not returned by the product lookup"))
    results = batch.withColumns({"outcome": F.when(got, "fetched").otherwise("unavailable"), "http_status": F.when(got, 200).otherwise(404), "error": error, "final_slug": F.coalesce("final_slug", "slug")})
    known = results.where(got).union(results.where(~got).join(products.select("slug"), "slug", "left_semi").select(*results.columns))
    rows, after, _ = apply_results(products, aliases, known)
    ids = fold(results.where(got).select("product_id", F.col("final_slug").alias("slug"), "ordinal"), "product_id", {"slug": "last"}, "ordinal")
    return rows, after, merge(source_ids, ids, "product_id", {"slug": "last"})


def completed(products: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(products, one row with the number of newly fetched ones) after records (slug, copy fields, categories, content_hash).

    Records that are complete fill known products; set values win, categories only where there are some. A slug that comes more than once is folded, the last
    by `ordinal` first, or by content hash where the batch has none. The retry time and the error of a filled product go.
    """
    whole = F.col("name").isNotNull() & F.col("description").isNotNull() & (F.col("tagline").isNotNull() | F.col("website_url").isNotNull())
    names = (*COPY, "categories", "content_hash")
    order = "ordinal" if "ordinal" in records.columns else "content_hash"
    filled = records.where(whole).withColumn("categories", F.when(F.size("categories") > 0, F.col("categories")))
    some = fold(filled, "slug", dict.fromkeys((*COPY, "categories"), "last_set") | ({"content_hash": "last"} if order == "ordinal" else {"content_hash": "max"}), order)
    both = products.join(some.select("slug", *(F.col(c).alias(f"_{c}") for c in names), F.lit(True).alias("_hit")), "slug", "left")
    hit = F.coalesce("_hit", F.lit(False))
    changes = {c: F.coalesce(f"_{c}", c) for c in COPY}
    changes["categories"] = F.when(F.coalesce(F.size("_categories"), F.lit(0)) > 0, F.col("_categories")).otherwise(F.col("categories"))
    changes |= {"content_hash": F.when(hit, F.col("_content_hash")).otherwise(F.col("content_hash")), "status": F.when(hit, "fetched").otherwise(F.col("status")), "http_status": F.when(hit, 200).otherwise(F.col("http_status"))}
    changes |= {c: F.when(~hit, F.col(c)) for c in ("next_retry_at", "last_error") if c in products.columns}
    fresh = both.agg(F.count_if(hit & (F.col("status") != "fetched")).alias("newly_fetched"))
    return both.withColumns(changes).select(*products.columns), fresh


def promote(products: DataFrame, external: DataFrame) -> DataFrame:
    """Unavailable products, and fetched ones with an empty description, as staged rows with name, tagline and web
    site give them: copy, categories and hash; a missing description falls back to the tagline, and the page's
    status, retry time and error are cleared."""
    ready = external.where("name is not null and tagline is not null and website_url is not null")
    digest = sql_content_hash([F.col(c) for c in ("slug", *COPY)], F.coalesce("categories", F.array().cast("array<string>")))
    fill = ready.select("slug", *(F.col(c).alias(f"_{c}") for c in ("name", "tagline", "website_url", "categories")), F.coalesce("description", "tagline").alias("_description"), digest.alias("_content_hash"), F.lit(True).alias("_ready"))
    both = products.join(fill, "slug", "left")
    hit = F.coalesce("_ready", F.lit(False)) & ((F.col("status") == "unavailable") | ((F.col("status") == "fetched") & F.coalesce(F.col("description") == "", F.lit(False))))
    both = both.withColumn("_hit", hit)
    changes = {c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)) for c in (*COPY, "categories", "content_hash")}
    changes |= {c: F.when(~F.col("_hit"), F.col(c)) for c in ("http_status", "next_retry_at", "last_error") if c in products.columns}
    return both.withColumns(changes | {"status": F.when(F.col("_hit"), "fetched").otherwise(F.col("status"))}).select(*products.columns)


def exclude_incomplete(products: DataFrame, aliases: DataFrame, reason: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(products, aliases, moved products, moved aliases): fetched rows without tagline or description leave, with their aliases."""
    out = F.coalesce((F.col("status") == "fetched") & (blank(F.col("tagline")) | blank(F.col("description"))), F.lit(False))
    moved = products.where(out).withColumn("exclusion_reason", F.lit(reason))
    theirs = moved.select(F.col("slug").alias("canonical_slug"))
    return products.where(~out), aliases.join(theirs, "canonical_slug", "left_anti"), moved, aliases.join(theirs, "canonical_slug", "left_semi").withColumn("exclusion_reason", F.lit(reason))


def claim_websites(products: DataFrame, enrichments: DataFrame, own_host: str, most_attempts: int, limit: int) -> DataFrame:
    """(slug, website_url, attempt, needs_tagline, needs_description): fetched rows whose own web site may fill a gap."""
    known = enrichments.select("slug", F.col("outcome").alias("_o"), F.col("attempts").alias("_a"), F.lit(True).alias("_tried"))
    gap = products.where("status = 'fetched'").withColumns({"needs_tagline": blank(F.col("tagline")), "needs_description": blank(F.col("description"))})
    gap = gap.where("needs_tagline or needs_description").where(F.col("website_url").rlike("(?i)^https?://[^ ]+$") & ~F.contains(F.lower("website_url"), F.lit(f"{own_host}/")))
    due = gap.join(known, "slug", "left").where(F.col("_tried").isNull() | ((F.col("_o") == "retry") & (F.col("_a") < most_attempts)))
    return due.orderBy("slug").limit(limit).select("slug", "website_url", (F.coalesce("_a", F.lit(0)) + 1).cast("long").alias("attempt"), "needs_tagline", "needs_description")


def requeue(rows: DataFrame, outcomes: list[str], allowed: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(rows, one row with their number): recoveries of these outcomes are open again; others than the allowed are an error."""
    if wrong := set(outcomes) - set(allowed):
        raise ValueError(f"can't requeue {sorted(wrong)}")
    chosen = F.col("outcome").isin(*outcomes)
    return rows.withColumn("outcome", F.when(chosen, "retry").otherwise(F.col("outcome"))), rows.agg(F.count_if(chosen).alias("requeued"))


def begin_run(runs: DataFrame, run_id: str, kind: str, now: Column) -> DataFrame:
    row = runs.sparkSession.createDataFrame([(run_id, kind)], "run_id string, kind string").withColumn("started_at", now)
    return runs.unionByName(row, allowMissingColumns=True)


def finish_run(runs: DataFrame, run_id: str, outcome: str, metrics: Column, now: Column) -> DataFrame:
    """The log with one run's end, outcome and metrics (a struct, kept as JSON)."""
    own = F.col("run_id") == run_id
    return runs.withColumns({"finished_at": F.when(own, now).otherwise(F.col("finished_at")), "outcome": F.when(own, F.lit(outcome)).otherwise(F.col("outcome")), "metrics": F.when(own, F.to_json(metrics)).otherwise(F.col("metrics"))})


def status_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(section, name, n): counts of all tables of the catalogue that are given; sections without rows are left out.

    Of scans and candidates the totals are counted, of rows with a state each state, of the rest the rows.
    """
    def states(name: str, column: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("section"), "name", "n")

    def one(section: str, frame: DataFrame, **what: Column) -> DataFrame:
        row = frame.agg(*(x.cast("long").alias(c) for c, x in what.items()))
        return row.unpivot([], list(what), "name", "n").select(F.lit(section).alias("section"), "name", F.coalesce("n", F.lit(0)).alias("n"))

    n, parts = F.count(F.lit(1)), []
    for name, rows in tables.items():
        columns = set(rows.columns)
        if name == "products":
            parts += [states(name, "status", rows), one(name, rows, total=n, ready_retry=F.count_if((F.col("status") == "retry") & F.col("next_retry_at").isNull()))]
        elif "path_kind" in columns and "slug" in columns:
            parts.append(states(name, "path_kind", rows))
        elif "outcome" in columns:
            parts.append(states(name, "outcome", rows))
        elif "new_product_id" in columns:
            parts.append(one(name, rows, products=F.count_distinct("product_id"), new_products=F.count_distinct(F.when(F.col("new_product_id"), F.col("product_id")))))
        elif "pages_scanned" in columns:
            parts.append(one(name, rows, scans=n, pages_scanned=F.sum("pages_scanned"), complete=F.count_if(F.col("pages_scanned") >= F.col("pages_count"))))
        else:
            parts.append(one(name, rows, rows=n))
    out = spark.createDataFrame([], "section string, name string, n long")
    for part in parts:
        out = out.unionByName(part)
    return out.where("n > 0")
