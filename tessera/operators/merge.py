"""Keyed merges over snapshots: what the catalogue's transactions do, as joins of the current rows with a batch.

Every merge takes the current table and a batch and gives the new table; nothing is changed in place. A batch
may hold a key more than once: an ordinal column says in which order its rows apply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(batch: DataFrame, key: str, rules: dict[str, str], ordinal: str) -> DataFrame:
    """One row per key. Rules: last, first, last_set (last non-null), first_set, max, min, any, sum."""
    def of(c: str, rule: str) -> Column:
        if rule == "last":
            return F.max_by(c, ordinal)
        if rule == "first":
            return F.min_by(c, ordinal)
        if rule == "last_set":
            return F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal)))
        if rule == "first_set":
            return F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal)))
        return {"max": F.max, "min": F.min, "any": F.bool_or, "sum": F.sum}[rule](c)

    return batch.groupBy(key).agg(*(of(c, r).alias(c) for c, r in rules.items()))


def merge(current: DataFrame, batch: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """Full outer merge of a batch with one row per key: per column, new and old values combine by the rule."""
    new = batch.select(F.col(key).alias("_k"), F.lit(True).alias("_new"), *(F.col(c).alias(f"_n_{c}") for c in rules))
    both = current.withColumn("_old", F.lit(True)).join(new, F.col(key) == F.col("_k"), "full_outer")

    def of(c: str, rule: str) -> Column:
        old, got = F.col(c), F.col(f"_n_{c}")
        combined = {
            "last": F.when(F.col("_new"), got).otherwise(old),
            "last_set": F.coalesce(got, old),
            "first_set": F.coalesce(old, got),
            "max": F.greatest(old, got),
            "min": F.least(old, got),
            "any": F.coalesce(old, F.lit(False)) | F.coalesce(got, F.lit(False)),
            "sum": F.coalesce(old, F.lit(0)) + F.coalesce(got, F.lit(0)),
            "keep": F.when(F.col("_old"), old).otherwise(got),
        }
        return combined[rule].alias(c)

    return both.select(F.coalesce(key, "_k").alias(key), *(of(c, r) for c, r in rules.items()), *(c for c in current.columns if c != key and c not in rules))


def insert_missing(current: DataFrame, batch: DataFrame, key: str, *barred: DataFrame) -> DataFrame:
    """The batch's rows whose key is neither in the table nor in any of the barred tables."""
    for other in (current, *barred):
        batch = batch.join(other.select(key), key, "left_anti")
    return batch


def claim(products: DataFrame, now: Column, limit: int, most_attempts: int) -> DataFrame:
    """The next products to fetch: pending first, then retries, newest change first."""
    due = F.col("status").isin("pending", "retry", "parse_failed") & (F.col("attempts") < most_attempts) & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now))
    place = F.when(F.col("status") == "pending", 0).when(F.col("status") == "retry", 1).otherwise(2)
    chosen = products.where(due).orderBy(place, F.desc_nulls_last("source_lastmod"), "first_seen_at", "slug").limit(limit)
    return chosen.withColumns({"attempts": F.col("attempts") + 1, "status": F.lit("retry"), "next_retry_at": F.lit(None).cast(products.schema["next_retry_at"].dataType)})


def replaced(current: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """The table with the changed rows in place of those with their keys."""
    return current.join(changed.select(key), key, "left_anti").unionByName(changed.select(*current.columns))


def reopened(products: DataFrame) -> DataFrame:
    """After a crash: claims without a retry time or error are pending again and get their attempt back."""
    open_ = (F.col("status") == "retry") & F.col("next_retry_at").isNull() & F.col("last_error").isNull()
    return products.withColumns({"attempts": F.when(open_, F.greatest(F.lit(0), F.col("attempts") - 1)).otherwise(F.col("attempts")), "status": F.when(open_, "pending").otherwise(F.col("status"))})


def requeued(products: DataFrame, statuses: list[str], reset_attempts: bool = False) -> DataFrame:
    chosen = F.col("status").isin(*statuses)
    out = products.withColumn("attempts", F.when(chosen & F.lit(reset_attempts), 0).otherwise(F.col("attempts")))
    return out.withColumn("status", F.when(chosen, "retry").otherwise(F.col("status")))


def quarantine(products: DataFrame, blank: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """(kept, moved): fetched rows with blank copy move out with a reason."""
    out = (F.col("status") == "fetched") & blank
    return products.where(~F.coalesce(out, F.lit(False))), products.where(out).withColumn("exclusion_reason", F.lit(reason))


def promoted(products: DataFrame, external: DataFrame) -> DataFrame:
    """Unavailable products, and fetched ones with an empty description, filled from staged external rows that
    have name, tagline and web site; a missing description falls back to the tagline."""
    ready = external.where("name is not null and tagline is not null and website_url is not null")
    fill = ready.select("slug", *(F.col(c).alias(f"_n_{c}") for c in ("name", "tagline", "website_url")), F.coalesce(F.nullif("description", F.lit("")), "tagline").alias("_n_description"))
    both = products.join(fill, "slug", "left")
    hit = F.col("_n_name").isNotNull() & ((F.col("status") == "unavailable") | ((F.col("status") == "fetched") & (F.coalesce("description", F.lit("x")) == "")))
    changes = {c: F.when(hit, F.col(f"_n_{c}")).otherwise(F.col(c)) for c in ("name", "tagline", "description", "website_url")}
    return both.withColumns({"_hit": hit}).withColumns(changes | {"status": F.when(F.col("_hit"), "fetched").otherwise(F.col("status"))}).select(*products.columns)


def latest_captures(captures: DataFrame, most_attempts: int) -> DataFrame:
    """Per product the newest capture that may still be tried."""
    rows = captures.where((F.col("outcome") != "recovered") & (F.col("attempts") < most_attempts))
    newest = rows.groupBy("slug").agg(F.max_by(F.struct(*rows.columns), F.struct("capture_timestamp", "crawl_id")).alias("r"))
    return newest.select("r.*")


def completeness(products: DataFrame) -> DataFrame:
    """Fetched rows, the complete ones among them, and the share; null without fetched rows."""
    whole = F.col("name").isNotNull() & F.col("description").isNotNull() & (F.col("tagline").isNotNull() | F.col("website_url").isNotNull())
    rows = products.where("status = 'fetched'")
    return rows.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(whole).alias("complete")).withColumn("completeness", F.try_divide("complete", "fetched"))
