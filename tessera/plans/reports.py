"""Counts of the catalogue's tables, one function for each table, and the check of the whole catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _named(rows: DataFrame, section: str, **numbers: Column) -> DataFrame:
    """(section, name, n) of numbers that one aggregation finds."""
    row = rows.agg(*(c.cast("long").alias(n) for n, c in numbers.items()))
    return row.unpivot([], list(numbers), "name", "n").select(F.lit(section).alias("section"), "name", F.coalesce("n", F.lit(0)).alias("n"))


def _states(rows: DataFrame, section: str, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(section).alias("section"), "name", "n")


def products(rows: DataFrame) -> DataFrame:
    """Products by status, all of them, and those that may be fetched again at once."""
    ready = F.count_if((F.col("status") == "retry") & F.col("next_retry_at").isNull())
    return _states(rows, "products", "status").unionByName(_named(rows, "products", total=F.count(F.lit(1)), ready_retry=ready))


def recoveries(rows: DataFrame, section: str = "recoveries") -> DataFrame:
    """Recoveries by outcome, and all of them."""
    return _states(rows, section, "outcome").unionByName(_named(rows, section, total=F.count(F.lit(1)), attempts=F.sum("attempts")))


def captures(rows: DataFrame) -> DataFrame:
    """Captures, their products and crawls, and those of each outcome."""
    return _states(rows, "captures", "outcome").unionByName(_named(rows, "captures", captures=F.count(F.lit(1)), products=F.count_distinct("slug"), crawls=F.count_distinct("crawl_id")))


def archived(candidates: DataFrame, scans: DataFrame) -> DataFrame:
    """Archived slugs by kind, and what the scans that found them read."""
    found = _states(candidates, "archived", "path_kind")
    return found.unionByName(_named(scans, "archived", scans=F.count(F.lit(1)), captures=F.sum("captures"), malformed_lines=F.sum("malformed_lines")))


def resolutions(rows: DataFrame) -> DataFrame:
    """Launches by outcome, those with an id, and the products that they lead to."""
    return _states(rows, "resolutions", "outcome").unionByName(_named(rows, "resolutions", with_post_id=F.count("post_id"), products=F.count_distinct("product_slug")))


def external(rows: DataFrame) -> DataFrame:
    """Staged rows of other catalogues by source, and those that are whole enough to be promoted."""
    whole = F.col("name").isNotNull() & F.col("tagline").isNotNull() & F.col("website_url").isNotNull()
    return _states(rows, "external", "source").unionByName(_named(rows, "external", total=F.count(F.lit(1)), complete=F.count_if(whole), with_product_id=F.count("product_id")))


def websites(rows: DataFrame) -> DataFrame:
    """Web-site enrichments by outcome, and the fields that they filled."""
    filled = {f"applied_{c}s": F.count_if(F.col(f"applied_{c}")) for c in ("tagline", "description")}
    return _states(rows, "websites", "outcome").unionByName(_named(rows, "websites", **filled))


def excluded(rows: DataFrame) -> DataFrame:
    """Products that were moved out, by reason."""
    return _states(rows, "excluded", "exclusion_reason")


def status(*parts: DataFrame) -> DataFrame:
    """One report of several; sections without rows are left out."""
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """(n): how many values of a column are held by more than one row."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))


def verify(rows: DataFrame) -> DataFrame:
    """One row: products, fetched and unparsed ones, complete ones among the fetched, the shares, values of slug and product_url held twice, and `passed`: none is.

    A share is null where there is nothing to divide by.
    """
    set_ = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    whole = (F.col("status") == "fetched") & set_("name") & set_("description") & (F.col("tagline").isNotNull() | F.col("website_url").isNotNull())
    counts = rows.agg(F.count(F.lit(1)).alias("products"), F.count_if(F.col("status") == "fetched").alias("fetched"), F.count_if(F.col("status") == "parse_failed").alias("parse_failed"), F.count_if(whole).alias("complete_fetched"))
    for key in ("slug", "product_url"):
        counts = counts.crossJoin(F.broadcast(duplicates(rows, key).select(F.col("n").alias(f"duplicate_{key}s"))))  # one row each
    shares = {"fetched_completeness": F.try_divide("complete_fetched", "fetched"), "reachable_parse_success": F.try_divide(F.col("fetched"), F.col("fetched") + F.col("parse_failed"))}
    return counts.withColumns(shares).withColumn("passed", (F.col("duplicate_slugs") == 0) & (F.col("duplicate_product_urls") == 0))
