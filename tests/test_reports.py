"""Panels, reports and the check against SQL, and odd tables."""

import html

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import final_slug
from tessera.plans import report_queries, reports
from tessera.sources.imports import unescaped
from tests.test_mart import con, same  # noqa: F401


@pytest.mark.parametrize("name", sorted(report_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):  # noqa: F811
    same(report_queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(report_queries.SQL[name]).df())


def test_verify_of_an_empty_catalogue(spark):
    kind = "slug string, product_url string, status string, name string, description string, tagline string, website_url string"
    row = reports.verify(spark.createDataFrame([], kind)).first()
    assert row["products"] == 0 and row["fetched_completeness"] is None and row["reachable_parse_success"] is None and row["passed"]
    twice = spark.createDataFrame([("a", None, "fetched", "A", "d", None, "w"), ("a", None, "fetched", "A", " ", "", None), (None, "u", "parse_failed", None, None, None, None)], kind)
    row = reports.verify(twice).first()
    assert (row["complete_fetched"], row["fetched"], row["duplicate_slugs"], row["duplicate_product_urls"], row["passed"]) == (2, 2, 1, 0, False)


def test_final_slugs(spark):
    some = {"https://h.example/products/Foo": "foo", "https://h.example/products/Foo/": "foo", "https://h.example/products/foo/reviews": "asked", "https://h.example/posts/foo": "asked", "https://h.example/products": "asked", "https://h.example": "asked", "https://h.example//products//Foo?x=/a/b": "foo", "nonsense": "asked", None: "asked"}
    rows = spark.createDataFrame([(u,) for u in some], "u string").select("u", final_slug(F.col("u"), F.lit("asked")).alias("s")).collect()
    assert {r["u"]: r["s"] for r in rows} == some


def test_every_entity(spark):
    some = ["&eacute;&#233;&#xE9;&hellip;", "&nosuch; & &amp;lt;", "&#8364 x", "plain", "a<br>b<br/>c", "  ", None, "&nbsp;"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(some)], "i int, t string").select("i", unescaped(F.col("t")).alias("u")).orderBy("i").collect()
    assert [r["u"] for r in rows[:4]] == [html.unescape(t) for t in some[:4]] and rows[4]["u"] == "a\nb\nc" and not rows[5]["u"] and rows[6]["u"] is None
