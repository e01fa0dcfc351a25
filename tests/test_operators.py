"""Relational operators on small frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.relational import best_per_key, ieee_div, ntile, pair_counts


@pytest.mark.parametrize("n", [1, 3, 19, 20, 21, 69])
def test_ntile_is_exact(spark, n):
    rows = spark.createDataFrame([(f"s{i:03}", i * i) for i in range(n)], "slug string, k long")
    got = {r["slug"]: r["t"] for r in ntile(rows, 20, "k", "slug", "t", buckets=7).collect()}
    want = {r["slug"]: r["t"] for r in rows.selectExpr("slug", "CAST(ntile(20) OVER (ORDER BY k, slug) AS BIGINT) AS t").collect()}
    assert got == want


def test_ieee_division(spark):
    rows = spark.createDataFrame([(1, 0), (-1, 0), (0, 0), (3, 2), (None, 1)], "n long, d long")
    got = [r["x"] for r in rows.select(ieee_div(F.col("n"), F.col("d")).alias("x")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == 1.5 and got[4] is None


def test_best_per_key_and_pairs(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 3), ("a", "y", 2), ("b", "y", 1), ("b", "x", 9)], "slug string, label string, score int")
    best = best_per_key(rows, ["slug", "label"], [F.desc("score")])
    assert {(r.slug, r.label): r.score for r in best.collect()} == {("a", "x"): 3, ("a", "y"): 2, ("b", "y"): 1, ("b", "x"): 9}
    assert [tuple(r) for r in pair_counts(best, "slug", ["label"]).collect()] == [("x", "y", 2)]


def test_ntile_where_quantiles_differ_between_evaluations(spark, monkeypatch):
    """As on a cluster, where the digests of tasks are merged in the order of their arrival."""
    exact, shift = F.percentile_approx, F.udf(lambda cuts: [c + random.randrange(40) for c in cuts], "array<bigint>").asNondeterministic()
    rows = spark.range(2000).selectExpr("concat('p', id) AS slug", "id * 3 AS k").repartition(4)
    want = {f"p{i}": i // 100 + 1 for i in range(2000)}
    monkeypatch.setattr(F, "percentile_approx", lambda *args: shift(exact(*args)))
    assert {r["slug"]: r["t"] for r in ntile(rows, 20, "k", "slug", "t", buckets=16).collect()} == want


def test_ntile_of_no_rows(spark):
    assert ntile(spark.createDataFrame([], "slug string, k long"), 20, "k", "slug", "t").count() == 0
