"""Bounded samples that are the same however rows are dealt."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def failure_samples(rows: DataFrame, kind: str, slug: str, attempt: str, body: str, most: int = 10, most_bytes: int = 512_000) -> DataFrame:
    """(kind, file_name, body): of every kind of failure at most `most` bodies, each cut to `most_bytes` bytes.

    Rows without a body don't count. Those with the smallest digest of slug and attempt are taken, ties to the smaller slug and body: every task keeps the best `most` of each kind, so no kind is gathered. File names keep
    letters, digits, - and _ of the slug, 100 at most.
    """
    cut = F.substring(F.col(f"`{body}`").cast("binary"), 1, most_bytes)
    digest = F.md5(F.concat_ws("-", F.col(f"`{slug}`").cast("string"), F.col(f"`{attempt}`").cast("string")))
    some = rows.where(F.col(f"`{body}`").isNotNull()).select(F.col(f"`{kind}`").alias("kind"), F.col(f"`{slug}`").cast("string").alias("slug"), F.col(f"`{attempt}`").alias("attempt"), digest.alias("digest"), cut.alias("body"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy("digest", "slug", "body"))
    kept = some.withColumn("place", place).where(F.col("place") <= most)
    name = F.concat(F.substring(F.regexp_replace("slug", r"[^\p{L}\p{N}_-]", ""), 1, 100), F.lit("-attempt-"), F.col("attempt").cast("string"), F.lit(".html"))
    return kept.select("kind", name.alias("file_name"), "body")
