"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Every step is one grouped minimum and one join, so a node with very many neighbours is a skewed join that
adaptive execution splits; no neighbour list is ever gathered. Each round is written to a staged table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import common


def apart(key: str) -> Column:
    """A grouping key as a new expression: a join on it gets exchanges of its own, whose hot partitions can be split."""
    return F.when(F.col(key).isNotNull(), F.col(key))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(apart("u").alias("k"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(apart("u").alias("k"), "m")
    others = down.join(least, F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node of its component, itself included as a row.

    Nodes are numbers, or structs of them, which are ordered by their first fields first.
    Edges with a null end are ignored; loops and repeated edges do no harm; no edges give no rows.
    """
    now = common.staged(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    state = None
    while True:
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == state:
            break
        state = after
        before, now = now, common.staged(_small_star(_large_star(now)), "edges")
        common.drop_staged(before)
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
