"""Lost products played back from the capture nearest to a wanted time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.markup import page_parts, product_fields
from tessera.functions.text import blank, sql_content_hash
from tessera.operators.asof import nearest
from tessera.plans.catalogue import COPY


def capture_time(digits: Column) -> Column:
    """The time of a capture's stamp: 14 digits, or fewer by twos down to the year, the rest at its least; null if it is no such stamp."""
    whole = F.concat(digits, F.substr(F.lit("YYYY0101000000"), F.length(digits) + 1))
    return F.when(digits.rlike("^[0-9]{4}([0-9]{2}){0,5}$"), F.try_to_timestamp(whole, F.lit("yyyyMMddHHmmss")))


def nearest_captures(targets: DataFrame, captures: DataFrame, wanted: Column) -> DataFrame:
    """Targets (slug, attempt) with the capture (slug, timestamp as digits, capture_id) of their slug nearest to the time `wanted`.

    Captures with another stamp than digits don't count; of two at one time the greater capture_id does, of two as near the earlier.
    """
    timed = captures.withColumn("time", capture_time(F.col("timestamp"))).where("time IS NOT NULL")
    found = nearest(targets.withColumn("time", wanted), timed, "slug", "time", ["capture_id"])
    return found.select("slug", "attempt", F.col("found.timestamp").alias("capture_timestamp"), F.col("found.capture_id").alias("capture_id"))


def replayed(targets: DataFrame, captures: DataFrame, pages: DataFrame, wanted: Column, product_url: Column) -> DataFrame:
    """Recoveries (slug, attempt, outcome, capture_timestamp, http_status, error, copy fields, content_hash) of targets.

    pages: capture_id, http_status, html (null where playback failed). A target is `no_capture` without one, `retry` where its page can't be
    had, `parse_failed` where name, description or both of tagline and web site lack, and else `recovered`. Pages are joined after the
    search, by id, so that only those that are needed travel. `product_url` is a column over `slug`.
    """
    chosen = nearest_captures(targets, captures, wanted)
    page = pages.select("capture_id", "http_status", "html")
    rows = chosen.join(page, "capture_id", "left").withColumn("parts", F.when(F.col("html").isNotNull(), page_parts("html", "slug")))
    fields = product_fields(F.col("parts"), F.col("slug"), product_url)
    rows = rows.select("slug", "attempt", "capture_timestamp", "http_status", "html", *(c.alias(n) for n, c in fields.items()))
    lacking = blank(F.col("name")) | blank(F.col("description")) | (blank(F.col("tagline")) & blank(F.col("website_url")))
    outcome = F.when(F.col("capture_timestamp").isNull(), "no_capture").when(F.col("html").isNull(), "retry").when(lacking, "parse_failed").otherwise("recovered")
    rows = rows.withColumn("outcome", outcome)
    good = F.col("outcome") == "recovered"
    error = F.when(F.col("outcome") == "parse_failed", "archived page is missing one or more catalogue fields").when(F.col("outcome") == "retry", "no page of the capture")
    digest = sql_content_hash([F.col("slug"), *(F.col(c) for c in COPY)], F.col("categories"))
    return rows.select(
        "slug", "attempt", "outcome", F.when(F.col("outcome") != "retry", F.col("capture_timestamp")).alias("capture_timestamp"), F.when(F.col("html").isNotNull(), F.col("http_status")).alias("http_status"), error.alias("error"),
        *(F.when(good, F.col(c)).alias(c) for c in (*COPY, "categories")), F.when(good, digest).alias("content_hash"),
    )
