"""Batches of rows for lookups that take a bounded number of keys and bytes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.scratch import written


# The text of a lookup, whose length bounds a batch.
HEAD = "query ProductSlugBatch"
FIELD = "{id slug name tagline description websiteUrl categories{name} meta{description}}"


def numbered(rows: DataFrame, order: str, out: str = "position") -> DataFrame:
    """Rows with their position, from 0, in the order of a column of different values, without one task for all.

    The rows are dealt by ranges and written; counts of each range, of which there are as many as partitions, give each its first position.
    """
    ranged = written(rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return ranged.join(F.broadcast(starts), "_range").withColumn(out, F.col("_start") + within - 1).drop("_range", "_start")


def json_bytes(text: Column) -> Column:
    """Bytes of a text as a JSON string, quotes included."""
    return F.octet_length(F.to_json(F.struct(text.alias("s")))) - 6


def slug_batches(rows: DataFrame, slug: str, most: int = 100, limit: int = 24_000, field: str = FIELD, head: str = HEAD) -> DataFrame:
    """(slug, batch, part, place): every slug in one request of at most `limit` bytes.

    Slugs in order fall into batches of `most`; a batch whose request would be larger is halved, the smaller half first, and its halves again. Null and repeated
    slugs are asked for once or not at all; a single slug beyond the limit is an error. A request is `head{p0:product(slug:"...")field p1:...}`.
    """
    keys = rows.select(F.col(f"`{slug}`").alias("slug")).where("slug IS NOT NULL").distinct()
    placed = numbered(keys, "slug").select("slug", F.floor(F.col("position") / most).alias("batch"), (F.col("position") % most).alias("place"))
    placed = placed.withColumns({"bytes": json_bytes(F.col("slug")) + len(":product(slug:)") + 1 + len(field.encode()), "part": F.lit(0).cast("long")})
    run = Window.partitionBy("batch", "part")
    n = F.count(F.lit(1)).over(run)
    size = F.sum(F.col("bytes") + F.length(F.col("place").cast("string"))).over(run) + n - 1 + len(head.encode()) + 2
    for _ in range(math.ceil(math.log2(most))):
        placed = placed.withColumns({"_n": n, "_size": size}).withColumn("_half", F.floor(F.col("_n") / 2))
        placed = placed.withColumn("_second", (F.col("_size") > limit) & (F.col("place") >= F.col("_half")) & (F.col("_n") > 1))
        # parts are numbered like the nodes of a tree, so that they keep the order of their slugs
        placed = placed.select("slug", "batch", "bytes", F.when(F.col("_second"), F.col("place") - F.col("_half")).otherwise(F.col("place")).alias("place"), (F.col("part") * 2 + F.col("_second").cast("long")).alias("part"))
    placed = placed.withColumn("_size", size)
    placed = placed.withColumn("size", F.when(F.col("_size") > limit, F.raise_error(F.lit("one slug exceeds the limit of a request")).cast("long")).otherwise(F.col("_size")))
    return placed.select("slug", "batch", "part", "place", "size")


def requests(batches: DataFrame, head: str = HEAD, field: str = FIELD) -> DataFrame:
    """(batch, part, slugs, text): the request of every part; a part has a bounded number of slugs and bytes."""
    one = F.concat(F.lit("p"), F.col("place").cast("string"), F.lit(":product(slug:"), F.substring(F.to_json(F.struct(F.col("slug").alias("s"))), 6, 1 << 30))
    one = F.concat(F.regexp_replace(one, r"\}$", ")"), F.lit(field))
    rows = batches.groupBy("batch", "part").agg(F.array_sort(F.collect_list(F.struct("place", "slug", one.alias("q")))).alias("r"))
    return rows.select("batch", "part", F.col("r.slug").alias("slugs"), F.concat(F.lit(head + "{"), F.array_join("r.q", " "), F.lit("}")).alias("text"))
