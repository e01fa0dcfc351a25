"""Whole rows after batches against results that are applied one after the other, and queries against SQL."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.plans import outcome_queries, outcomes
from tessera.plans import recovery as R
from tests.test_mart import con, same  # noqa: F401

PAGE = "product_url string, name string, tagline string, description string, website_url string, categories array<string>, content_hash string"
PRODUCTS = f"slug string, status string, attempts long, http_status int, next_retry_at long, last_error string, fetched_at long, {PAGE}, source_lastmod long"
RESULTS = f"slug string, final_slug string, outcome string, attempt long, http_status int, error string, retry_at long, capture_timestamp string, {PAGE}, ordinal long"
ALIASES = "alias_slug string, canonical_slug string, http_status int"
COPIED = [c.split()[0] for c in PAGE.split(", ")]


@pytest.mark.parametrize("name", sorted(outcome_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):  # noqa: F811
    same(outcome_queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(outcome_queries.SQL[name]).df())


def product(slug, i):
    return {"slug": slug, "status": random.Random(i).choice(["fetched", "pending"]), "attempts": i % 4, "http_status": None, "next_retry_at": i, "last_error": "old", "fetched_at": 1, **dict.fromkeys(COPIED), "name": f"old {slug}", "source_lastmod": i}


def result(rng, i, slugs):
    slug = rng.choice(slugs)
    page = {c: (None if rng.random() < 0.3 else [f"{c}{i}"] if c == "categories" else f"{c}{i}") for c in COPIED}
    return {"slug": slug, "final_slug": rng.choice([slug, slug, rng.choice(slugs)]), "outcome": rng.choice(["fetched", "fetched", "retry", "unavailable"]), "attempt": rng.randrange(9), "http_status": rng.choice([200, None]), "error": rng.choice([None, f"e{i}"]), "retry_at": i, "capture_timestamp": None, **page, "ordinal": i}


def one_by_one(products, aliases, results):
    rows, links = {p["slug"]: dict(p) for p in products}, dict(aliases)
    for r in results:
        page = {c: r[c] for c in COPIED} | {"status": "fetched", "http_status": r["http_status"], "fetched_at": 9, "next_retry_at": None, "last_error": None}
        if r["outcome"] == "fetched" and r["final_slug"] != r["slug"]:
            old = rows.get(r["final_slug"], {"slug": r["final_slug"], "attempts": 0, "source_lastmod": None})
            rows[r["final_slug"]] = old | page | {"attempts": max(old["attempts"], r["attempt"])}
            rows.pop(r["slug"], None)
            links[r["slug"]] = (r["final_slug"], r["http_status"])
        elif r["slug"] in rows and r["outcome"] == "fetched":
            rows[r["slug"]] |= page
        elif r["slug"] in rows:
            rows[r["slug"]] |= {"status": r["outcome"], "http_status": r["http_status"], "next_retry_at": r["retry_at"], "last_error": r["error"]}
    return rows, links


@pytest.mark.parametrize("seed", range(4))
def test_equals_one_by_one(spark, seed):
    rng = random.Random(seed)
    slugs = [f"s{i}" for i in range(60)]
    products = [product(s, i) for i, s in enumerate(slugs) if i % 3]
    results = [result(rng, i, slugs) for i in range(260)]
    aliases = {"s0": ("s1", 301), "other": ("s2", 301)}
    frame = lambda rows, schema: spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    shuffled = rng.sample(results, len(results))
    got, links = outcomes.apply_fetches(frame(products, PRODUCTS), spark.createDataFrame([(a, *x) for a, x in aliases.items()], ALIASES), frame(shuffled, RESULTS), F.lit(9).cast("long"))
    rows, want = one_by_one(products, aliases, results)
    assert {r["slug"]: r.asDict() for r in got.collect()} == rows and got.count() == len(rows)
    assert {r["alias_slug"]: (r["canonical_slug"], r["http_status"]) for r in links.collect()} == want


def test_empty_batch(spark):
    products = spark.createDataFrame([tuple(product("a", 1).values())], PRODUCTS)
    aliases = spark.createDataFrame([("x", "a", 301)], ALIASES)
    rows, links = outcomes.apply_fetches(products, aliases, spark.createDataFrame([], RESULTS), F.lit(9).cast("long"))
    assert rows.collect() == products.collect() and links.collect() == aliases.collect()


def test_repeats_double_nothing(spark):
    products = spark.createDataFrame([("a", "unavailable", None, "A", None, None, None, ["x"], "old", "gone", 7)], "slug string, status string, http_status int, name string, tagline string, description string, website_url string, categories array<string>, content_hash string, last_error string, next_retry_at long")
    records = spark.createDataFrame([("a", "B", "t", "d", None, ["y"], "h1", 1), ("a", "C", None, "e", "w", [], "h2", 2), ("a", "D", None, None, None, None, "h3", 3)], "slug string, name string, tagline string, description string, website_url string, categories array<string>, content_hash string, ordinal int")
    rows, fresh = R.completed(products, records)
    assert [tuple(r) for r in rows.collect()] == [("a", "fetched", 200, "C", "t", "e", "w", ["y"], "h2", None, None)] and fresh.first()[0] == 1
    captures = spark.createDataFrame([("a", "c", "pending", 0, None, None)], "slug string, crawl_id string, outcome string, attempts int, http_status int, last_error string")
    changes = spark.createDataFrame([("a", "c", "fetch_failed", 1, 500, "e", 1), ("a", "c", "recovered", 2, 200, None, 2)], "slug string, crawl_id string, outcome string, attempt int, http_status int, error string, ordinal int")
    for batch in (changes, changes.drop("ordinal")):
        assert [tuple(r) for r in R.capture_outcomes(captures, batch).collect()] == [("a", "c", "recovered", 2, 200, None)]
    scans = spark.createDataFrame([("posts", "k1", 1, 5, False)], "path_kind string, resume_key string, requests long, captures long, complete boolean")
    pages = spark.createDataFrame([("posts", 3, "k2", 1), ("posts", 4, None, 2)], "path_kind string, captures long, next_resume_key string, ordinal int")
    assert [tuple(r) for r in R.resumed(scans, pages).collect()] == [("posts", None, 3, 12, True)]
