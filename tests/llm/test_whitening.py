"""Whitening against numpy, and on odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, whitening

SCHEMA = "vec_id long, embedding array<double>, n int, x string"  # clashing names


def brute_force(x, components=4):
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    centred = fit - total / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, (x - total / n) @ vectors[:, :components] / np.sqrt(values[:components]), ((n * x - total) ** 2).sum(1), values / values.sum()


@pytest.mark.parametrize("table", ["given", "few dimensions", "far from zero"])
def test_equals_numpy(spark, sf_dir, table):
    if table == "given":
        rows = common.table(spark, sf_dir, "embeddings").union(common.table(spark, sf_dir, "embeddings").limit(20))
    else:
        rng = np.random.default_rng(1)
        values = rng.normal(0, [3, 2, 1], (200, 3)) if table == "few dimensions" else rng.normal(1e6, [8, 5, 3, 2, 1, 1, 1, 1, 1], (300, 9))
        rows = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(np.vstack([values, values[:50]]))], SCHEMA)
    pdf = rows.toPandas().reset_index(drop=True)
    x = np.floor(256 * np.stack(pdf.embedding.values).astype(float)).astype(np.int64)
    n, want, deviation, explained = brute_force(x)
    got = whitening.whiten(rows).toPandas()
    k = min(4, x.shape[1])
    assert len(got) == k * len(pdf) and (got.n == n).all() and (got.identity_error < 1e-9).all()
    keyed = {(v, tuple(a)): i for i, (v, a) in enumerate(zip(pdf.vec_id, x.tolist(), strict=True))}
    by_id = got.sort_values(["vec_id", "component"]).groupby(["vec_id", "component"]).first()
    signs = None
    for (vec_id, _), i in keyed.items():
        mine = by_id.loc[vec_id]
        signs = np.sign(mine.whitened.values * want[i]) if signs is None else signs
        assert np.allclose(mine.whitened.values * signs, want[i], rtol=1e-9, atol=1e-9)
        assert mine.deviation.iloc[0] == deviation[i] and np.allclose(mine.explained, explained[:k], rtol=1e-9)


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, [1e300, 0.0]), (7, [2.0]), (8, [-0.0, 0.0]), (9, [])]
    got = whitening.whiten(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)).collect()
    x = np.array([[256, 512], [256, 512], [128, -256], [512, 0], [0, 0], [0, 0]])
    n, _, deviation, _ = brute_force(x, 2)
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted((i, k) for i in (1, 1, 0, 7, 8, 9) for k in (1, 2))
    assert n == 4 and sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviation.tolist())


def test_large_numbers(spark):
    rows = [(i, [float(2**52 + i), float(-(2**53)), 0.0], 1, "x") for i in range(4)] + [(9, [float(-(2**54)), 1.0, 0.0], 1, "x")]
    got = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).where("component = 1").collect()}
    assert len(got) == 5 and all(r["deviation"] is None and np.isfinite(r["whitened"]) for r in got.values())


def test_nothing_varies(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1, "x"), (2, [1.0, 2.0, 3.0], 1, "x")], SCHEMA)
    got = whitening.whiten(one).collect()
    assert len(got) == 6 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 and r["n"] == 1 for r in got)
    flat = spark.createDataFrame([(i, [float(i), float(2 * i), 7.0], 1, "x") for i in range(5)], SCHEMA)
    got = {(r["vec_id"], r["component"]): r["whitened"] for r in whitening.whiten(flat).collect()}
    assert all((v is None) == (k > 1) for (_, k), v in got.items())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for rows in (empty, spark.createDataFrame([(1, [], 1, "x"), (2, None, 1, "x")], SCHEMA)):
        got = whitening.whiten(rows)
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_every_pair_once(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(-9, 9, (40, 13)).astype(float)
    rows = spark.createDataFrame([(v.tolist(),) for v in y], "y array<double>")
    assert (whitening.cross_products(rows, 13) == y.T @ y).all()
    assert (whitening.cross_products(rows.select(F.slice("y", 1, 1).alias("y")), 1) == (y.T @ y)[:1, :1]).all()
