"""Reusable relational operators: best row per key, shares, exact n-tiles, trends and pair counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType


def best_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by `order`, found by a window over the key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def ieee_div(n: Column, d: Column) -> Column:
    """Division of doubles with infinities and NaN instead of an error; null stays null."""
    n, d = n.cast("double"), d.cast("double")
    zero = F.when(n == 0, F.lit(float("nan"))).when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf")))
    return F.when(d == 0, zero).otherwise(n / F.when(d != 0, d))


def with_total(grouped: DataFrame, whole: DataFrame, name: str = "_all") -> DataFrame:
    """Attach a one-row count of `whole` to every row."""
    return grouped.crossJoin(F.broadcast(whole.agg(F.count(F.lit(1)).alias(name))))


def ntile(rows: DataFrame, n: int, number: str, tie: str, out: str, buckets: int = 256) -> DataFrame:
    """Exact n-tiles over (number, tie) without gathering all rows in one task.

    Rows fall into buckets of `number` between approximate quantiles, which hold about as many rows each however
    the numbers lie; the counts of earlier buckets give each bucket's first position, so only a bucket's own rows
    are ordered together. The quantiles (at most `buckets` numbers) are fixed when the plan is made: they depend on the order in
    which tasks' digests are merged, and a bucket's count and its rows must be told apart by the same ones.
    """
    cuts = [i / buckets for i in range(1, buckets)]
    span = rows.agg(F.percentile_approx(number, cuts, F.lit(10 * buckets)).alias("cuts"), F.count(F.lit(1)).alias("n")).first()
    kind = StructType([StructField("_cuts", ArrayType(rows.schema[number].dataType))])
    fixed = rows.sparkSession.createDataFrame([(span["cuts"] or [],)], kind)
    above = F.aggregate("_cuts", F.lit(0).cast("long"), lambda n, cut: n + (F.col(number) > cut).cast("long"))
    dealt = rows.crossJoin(F.broadcast(fixed)).withColumn("_bucket", F.coalesce(above, F.lit(-1).cast("long")))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_c"))
    starts = starts.select("_bucket", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"))  # at most `buckets` rows
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(number, tie))
    placed = dealt.join(F.broadcast(starts), "_bucket").withColumn("_i", F.col("_start") + within - 1)
    q, r = divmod(span["n"], n)
    large = r * (q + 1)
    tile = F.when(F.col("_i") < large, F.floor(F.col("_i") / (q + 1))).otherwise(r + F.floor((F.col("_i") - large) / max(q, 1)))
    return placed.withColumn(out, (tile + 1).cast("long")).drop("_cuts", "_bucket", "_start", "_i")


def pair_counts(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Counts of unordered pairs of values under one key: an equi-join with an order on the values left over."""
    a = rows.select(F.col(key), *(F.col(v).alias(f"{v}_a") for v in values)).alias("a")
    b = rows.select(F.col(key), *(F.col(v).alias(f"{v}_b") for v in values)).alias("b")
    order = F.struct(*(F.col(f"{v}_a") for v in values)) < F.struct(*(F.col(f"{v}_b") for v in values))
    joined = a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & order)
    return joined.groupBy(*(f"{v}_a" for v in values), *(f"{v}_b" for v in values)).agg(F.count(F.lit(1)).alias("products"))
