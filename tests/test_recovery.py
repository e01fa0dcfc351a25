"""Recovery transactions against their SQL, and those of state rows on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.plans import recovery as R
from tessera.plans import recovery_queries
from tests.test_mart import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(recovery_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):  # noqa: F811
    same(recovery_queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(recovery_queries.SQL[name]).df())


def test_resume_keys(spark):
    scans = spark.createDataFrame([("posts", "k1", 1, 5, False), ("products", None, 0, 0, False)], "path_kind string, resume_key string, requests long, captures long, complete boolean")
    batch = spark.createDataFrame([("posts", 3, None), ("products", 2, "k2")], "path_kind string, captures long, next_resume_key string")
    assert sorted(tuple(r) for r in R.resumed(scans, batch).collect()) == [("posts", None, 2, 8, True), ("products", "k2", 1, 2, False)]


def test_run_log(spark):
    runs = spark.createDataFrame([], "run_id string, kind string, started_at long, finished_at long, outcome string, metrics string")
    runs = R.begin_run(R.begin_run(runs, "a", "import", F.lit(1).cast("long")), "b", "scan", F.lit(2).cast("long"))
    got = {r["run_id"]: r for r in R.finish_run(runs, "a", "ok", F.struct(F.lit(3).alias("rows")), F.lit(4).cast("long")).collect()}
    assert json.loads(got["a"]["metrics"]) == {"rows": 3} and got["a"]["finished_at"] == 4 and got["b"]["outcome"] is None


def test_wrong_outcomes_are_refused(spark):
    captures = spark.createDataFrame([("s", "c", "pending", 0, None, None)], "slug string, crawl_id string, outcome string, attempts long, http_status int, last_error string")
    change = captures.select("slug", "crawl_id", F.lit("odd").alias("outcome"), F.lit(1).alias("attempt"), "http_status", F.col("last_error").alias("error"))
    with pytest.raises(Exception, match="no outcome of a capture"):
        R.capture_outcomes(captures, change).collect()
    with pytest.raises(ValueError):
        R.requeue(captures, ["recovered"], ("parse_failed",))
