"""As-of joins: to each row the row of its key that is nearest in time, before, after or on either side.

Both sides go into one table ordered by key and time, and windows carry the last row seen of the right side forwards and the next
one backwards. A key may hold a third of all rows, so windows run over (key, span of time) and not over the key: a second,
small pass over one summary a span carries rows on over the spans between. No key is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def nearest(left: DataFrame, right: DataFrame, key: str, time: str, order: list[str], side: str = "either", span: int = 30 * DAY, out: str = "found") -> DataFrame:
    """`left` with the struct `out` of the right row of its key nearest to its own time; null if there is none.

    `key` and `time` (a timestamp) name columns of both sides. `side`: before (or at), after (or at), either. Of right rows at one time
    the last by `order` counts; of two as far on either side the earlier one. Rows without a key or time find nothing and aren't found. `span` is in microseconds: it decides how
    the work is dealt, not the result. Columns of left called as `out` are replaced.
    """
    if side not in ("before", "after", "either"):
        raise ValueError(f"unknown side: {side}")
    other = F.struct(*(F.col(f"`{c}`") for c in right.columns))
    rows = right.select(F.col(f"`{key}`").alias("k"), _micros(F.col(f"`{time}`")).alias("t"), F.struct(*(F.col(f"`{c}`") for c in order)).alias("o"), other.alias("r")).where("k IS NOT NULL AND t IS NOT NULL")
    rows = rows.groupBy("k", "t").agg(F.max_by("r", "o").alias("r"))
    kept = [F.col(f"`{c}`") for c in left.columns if c != out]
    mine = left.select(F.col(f"`{key}`").alias("k"), _micros(F.col(f"`{time}`")).alias("t"), F.struct(*kept).alias("l"))
    none = F.lit(None)
    both = rows.select("k", "t", none.cast(mine.schema["l"].dataType).alias("l"), F.struct("t", "r").alias("r"))
    both = both.unionByName(mine.select("k", "t", "l", none.cast(both.schema["r"].dataType).alias("r")))
    both = both.withColumn("s", F.floor(F.col("t") / F.lit(span)))
    within = Window.partitionBy("k", "s")
    # right rows stand first among those of one time, so that both windows see them
    forward = within.orderBy("t", F.col("r").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    backward = within.orderBy(F.col("t").desc(), F.col("r").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumns({"before": F.last("r", ignorenulls=True).over(forward), "after": F.last("r", ignorenulls=True).over(backward)}).where("l IS NOT NULL")
    spans = both.groupBy("k", "s").agg(F.min_by("r", F.when(F.col("r").isNotNull(), F.col("t"))).alias("first"), F.max_by("r", F.when(F.col("r").isNotNull(), F.col("t"))).alias("last"))
    of_key = Window.partitionBy("k").orderBy("s")
    carried = spans.select(
        F.col("k").alias("_k"), F.col("s").alias("_s"),
        F.last("last", ignorenulls=True).over(of_key.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
        F.first("first", ignorenulls=True).over(of_key.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
    )
    done = seen.join(carried, (F.col("k") == F.col("_k")) & (F.col("s") == F.col("_s")), "left")
    done = done.withColumns({"before": F.coalesce("before", "earlier"), "after": F.coalesce("after", "later")})
    closer = (F.col("before").isNull()) | (F.col("after.t") - F.col("t") < F.col("t") - F.col("before.t"))
    pick = {"before": F.col("before"), "after": F.col("after"), "either": F.when(F.col("after").isNotNull() & closer, F.col("after")).otherwise(F.col("before"))}[side]
    return done.select("l.*", pick["r"].alias(out))
