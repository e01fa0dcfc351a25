"""As-of joins and playback: queries against SQL, ties, and every way of dealing the work."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.asof import nearest
from tessera.plans import playback, playback_queries
from tests.test_mart import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(playback_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):  # noqa: F811
    same(playback_queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(playback_queries.SQL[name]).df())


def at(n):
    return None if n is None else dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=n)


@pytest.mark.parametrize("side", ["before", "after", "either"])
@pytest.mark.parametrize("span", [1, 5_000_000, 10**15])
def test_equals_brute_force(spark, side, span):
    rng = random.Random(3)
    left = [(i, rng.choice(["a", "b", "c", None]), rng.choice([*range(-40, 40), None])) for i in range(150)]
    right = [(rng.choice(["a", "b", None]), rng.choice([*range(-35, 35, 3), None]), i) for i in range(60)]
    frame = spark.createDataFrame([(i, k, at(t), "mine") for i, k, t in left], "id int, key string, time timestamp, found string")
    got = {r["id"]: r["found"] and r["found"]["n"] for r in nearest(frame, spark.createDataFrame([(k, at(t), i, "x") for k, t, i in right], "key string, time timestamp, n int, l string"), "key", "time", ["n"], side, span).collect()}
    for i, k, t in left:
        some = [(u, n) for q, u, n in right if None not in (k, t, u) and q == k and (side != "before" or u <= t) and (side != "after" or u >= t)]
        want = min(some, key=lambda x: (abs(x[0] - t), x[0], -x[1]))[1] if some else None
        assert got[i] == want
    assert len(got) == len(left)


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", at(1))], "id int, key string, time timestamp")
    right = spark.createDataFrame([], "key string, time timestamp, n int")
    assert [r["found"] for r in nearest(left, right, "key", "time", ["n"]).collect()] == [None]
    assert nearest(left.limit(0), right, "key", "time", ["n"]).count() == 0
    with pytest.raises(ValueError):
        nearest(left, right, "key", "time", ["n"], "near")


def test_stamps(spark):
    some = ["2024", "202402", "20240203", "2024020304", "20240203040506", "20241301", "x", "", None, "123"]
    got = [r["t"] for r in spark.createDataFrame([(s,) for s in some], "s string").select(playback.capture_time(F.col("s")).cast("string").alias("t")).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-02-03 00:00:00", "2024-02-03 04:00:00", "2024-02-03 04:05:06", *[None] * 5]


def test_replay(spark):
    page = '<html><head><title>t</title><meta property="og:description" content="A tool for teams"></head><body><h1>Alpha</h1>{}</body></html>'
    visit = '<a data-test="visit-website" href="https://alpha.example">go</a>'
    targets = spark.createDataFrame([(s, 2) for s in ("alpha", "bare", "lost", "none", "odd")], "slug string, attempt long")
    captures = spark.createDataFrame([("alpha", "20200101", 1), ("alpha", "20230101", 2), ("alpha", "20230101", 3), ("bare", "20230101", 4), ("lost", "20230101", 5), ("odd", "never", 6)], "slug string, timestamp string, capture_id long")
    pages = spark.createDataFrame([(1, 200, "<html>"), (2, 200, "<html>"), (3, 200, page.format(visit)), (4, 200, page.format("")), (5, 503, None)], "capture_id long, http_status int, html string")
    rows = playback.replayed(targets, captures, pages, F.to_timestamp(F.lit("2023-06-01")), F.concat(F.lit("https://catalogue.example/products/"), F.col("slug")))
    got = {r["slug"]: r for r in rows.collect()}
    assert {s: (r["outcome"], r["capture_timestamp"], r["http_status"]) for s, r in got.items()} == {
        "alpha": ("recovered", "20230101", 200), "bare": ("parse_failed", "20230101", 200), "lost": ("retry", None, None), "none": ("no_capture", None, None), "odd": ("no_capture", None, None)}
    a = got["alpha"]
    assert (a["name"], a["description"], a["website_url"], a["attempt"]) == ("Alpha", "A tool for teams", "https://alpha.example", 2) and len(a["content_hash"]) == 64
    assert got["bare"]["name"] is None and got["bare"]["error"] and got["none"]["error"] is None
