"""The catalogue's transactions and captured answers on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.plans import catalogue as C
from tessera.plans.store import CursorChanged
from tessera.sources import payloads as P

PRODUCTS = "slug string, name string, tagline string, description string, website_url string, categories array<string>, status string, attempts int, http_status int, source_lastmod long, tagline_source string, description_source string, content_hash string"


def products(spark, *rows):
    full = [(*r, *(None,) * (13 - len(r))) for r in rows]
    return spark.createDataFrame(full, PRODUCTS)


def by(rows, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in rows.collect()}


def test_import(spark):
    now = products(spark, ("a", None, None, None, None, None, "fetched", 2, None, 5))
    aliases, excluded = spark.createDataFrame([("old", "a")], "alias_slug string, canonical_slug string"), spark.createDataFrame([("bad",)], "slug string")
    batch = spark.createDataFrame([("a", 3), ("b", None), ("b", 9), ("old", 1), ("bad", 1)], "slug string, lastmod long")
    got, inserted = C.import_products(now, aliases, excluded, batch)
    assert by(got, "slug", "status", "attempts", "source_lastmod") == {"a": ("fetched", 2, 5), "b": ("pending", 0, 9)} and [r["slug"] for r in inserted.collect()] == ["b"]
    again, inserted = C.import_products(got, aliases, excluded, batch)
    assert inserted.count() == 0 and again.count() == 2


def test_cursors(spark):
    scans = spark.createDataFrame([("ids", 100, 1), ("x", 5, 2)], "scan_name string, next_id long, requests long")
    C.checked_cursor(scans, "scan_name", "ids", "next_id", 100)
    with pytest.raises(CursorChanged):
        C.checked_cursor(scans, "scan_name", "ids", "next_id", 110)
    moved = C.advanced(scans, spark.createDataFrame([("ids", 110, 1)], "scan_name string, next_id long, requests long"), "scan_name", "next_id")
    assert by(moved, "scan_name", "next_id", "requests") == {"ids": (110, 2), "x": (5, 2)}
    pages = spark.createDataFrame([("ids", 110), ("x", 5)], "scan_name string, page long")
    C.checked_cursors(moved, pages, "scan_name", "page", "next_id")
    with pytest.raises(CursorChanged):
        C.checked_cursors(scans, pages, "scan_name", "page", "next_id")
    row = spark.createDataFrame([(150, 100), (450, 100)], "c int, o int").select(C.overflow_position(F.col("c"), F.col("o")).alias("n")).collect()
    assert [r["n"] for r in row] == [150, 200]


RECORD = "product_id long, slug string, name string, tagline string, description string, website_url string, ordinal int"


def test_id_scan(spark):
    now = products(spark, ("a", "A", None, "d", None, None, "fetched", 1), ("b", None, None, None, None, None, "pending", 0))
    ids = spark.createDataFrame([(1, "a", 10, 10)], "product_id long, slug string, first_seen_at long, last_seen_at long")
    aliases = spark.createDataFrame([("old", "a")], "alias_slug string, canonical_slug string")
    records = spark.createDataFrame([(1, "a", None, "t", None, None, 1), (2, "b", "B", None, "d", "w", 2), (3, "c", "C", None, None, None, 3), (4, "old", "O", "t", "d", "w", 4)], RECORD)
    rows, sources = C.apply_catalogue_batch(now, ids, aliases, records, F.lit(20).cast("long"))
    assert by(rows, "slug", "status", "name", "tagline") == {"a": ("fetched", "A", "t"), "b": ("fetched", "B", None), "c": ("pending", "C", None)}
    assert by(sources, "product_id", "slug", "first_seen_at", "last_seen_at") == {1: ("a", 10, 20), 2: ("b", 20, 20), 3: ("c", 20, 20), 4: ("old", 20, 20)}


def test_resolutions(spark):
    kind = "post_slug string, post_id long, product_id long, product_slug string, outcome string"
    now = spark.createDataFrame([("x", 7, None, None, "unavailable"), ("y", 8, 1, "p", "resolved")], kind)
    new = spark.createDataFrame([("x", 9, 2, "q", "resolved"), ("y", None, None, None, "unavailable"), ("z", 3, None, None, "no_product")], kind)
    assert by(C.resolutions(now, new, True), "post_slug", "post_id", "product_slug", "outcome") == {"x": (7, "q", "resolved"), "y": (8, "p", "resolved"), "z": (3, None, "no_product")}
    assert by(C.resolutions(now, new, False), "post_slug", "outcome") == {"x": ("unavailable",), "y": ("resolved",), "z": ("no_product",)}


def test_memberships(spark):
    known = spark.createDataFrame([(1, "a")], "product_id long, slug string")
    current = spark.createDataFrame([("c", 2, "b", True, 1, 1)], "category_slug string, product_id long, slug string, new_product_id boolean, first_seen_at long, last_seen_at long")
    found = spark.createDataFrame([("c", 1, "a"), ("c", 2, "b2"), ("d", 2, "b"), ("d", 3, "e"), ("d", 3, "e")], "category_slug string, product_id long, slug string")
    rows, fresh = C.memberships(current, found, known, ["category_slug", "product_id"], F.lit(5).cast("long"))
    got = {(r["category_slug"], r["product_id"]): (r["slug"], r["new_product_id"], r["first_seen_at"], r["last_seen_at"]) for r in rows.collect()}
    assert got == {("c", 1): ("a", False, 5, 5), ("c", 2): ("b2", True, 1, 5), ("d", 2): ("b", True, 5, 5), ("d", 3): ("e", True, 5, 5)} and fresh == 2


def test_external_aliases_and_enrichment(spark):
    staged = spark.createDataFrame([("a", "A", None, None, None, None, "one")], "slug string, name string, tagline string, description string, website_url string, product_id long, source string")
    rows = spark.createDataFrame([("a", "Z", "t", None, "w", 4, 1), ("b", "B", "t", "", None, None, 2)], "slug string, name string, tagline string, description string, website_url string, product_id long, ordinal int")
    assert by(C.stage_external(staged, rows, "two"), "slug", "name", "description", "source") == {"a": ("A", "t", "one"), "b": ("B", "t", "two")}
    now = products(spark, ("a", "A", " ", "d", "w", ["x"], "fetched", 1, 200, None, None, "api", "h"), ("b", "B", "t", None, None, None, "fetched", 1, 200, None, "api", None, "h"))
    aliases = spark.createDataFrame([], "alias_slug string, canonical_slug string")
    batch = spark.createDataFrame([("old", "a", 1), ("gone", "none", 2), ("a", "a", 3)], "alias_slug string, canonical_slug string, ordinal int")
    assert by(C.known_aliases(aliases, now, batch), "alias_slug", "canonical_slug") == {"old": ("a",)}
    found = spark.createDataFrame([("a", "new tagline", "h1", "other", "og"), ("b", None, None, " ", "og")], "slug string, tagline string, tagline_origin string, description string, description_origin string")
    got = by(C.enriched(now, found), "slug", "tagline", "tagline_source", "description", "description_source", "content_hash")
    assert got["a"][:4] == ("new tagline", "website:h1", "d", "api") and len(got["a"][4]) == 64 and got["b"] == ("t", "api", None, None, "h")


def test_results_and_captures(spark):
    now = products(spark, ("a", "A", None, None, None, None, "retry", 1), ("b", "B", None, None, None, None, "retry", 1), ("c", None, None, None, None, None, "retry", 1))
    aliases = spark.createDataFrame([], "alias_slug string, canonical_slug string")
    kind = "slug string, final_slug string, outcome string, http_status int, error string, name string, tagline string, description string, website_url string, ordinal int"
    results = spark.createDataFrame([("a", "n", "fetched", 200, None, "N", "t", "d", "w", 1), ("b", "b", "fetched", 200, None, None, "t", "d", None, 2), ("c", None, "unavailable", 404, "gone", None, None, None, None, 3)], kind)
    rows, links, errors = C.apply_results(now, aliases, results)
    assert by(rows, "slug", "status", "name", "tagline") == {"n": ("fetched", "N", "t"), "b": ("fetched", "B", "t"), "c": ("unavailable", None, None)}
    assert by(links, "alias_slug", "canonical_slug") == {"a": ("n",)} and [tuple(r) for r in errors.collect()] == [("c", 404, "gone")]
    captures = spark.createDataFrame([("a", "1", "t1", "recovered", 2), ("b", "1", "t1", "fetch_failed", 2)], "slug string, crawl_id string, capture_timestamp string, outcome string, attempts int")
    found = spark.createDataFrame([("a", "1", "t2"), ("b", "1", "t2"), ("c", "1", "t2")], "slug string, crawl_id string, capture_timestamp string")
    assert by(C.capture_scan(captures, found), "slug", "capture_timestamp", "outcome", "attempts") == {"a": ("t1", "recovered", 2), "b": ("t2", "pending", 0), "c": ("t2", "pending", 0)}
    assert by(C.counts_by(now, "status"), "state", "n") == {"retry": (3,)}
    assert by(C.duplicate_keys(now.union(now.limit(1)), "slug", "name"), "key", "n")["slug"] == (1,)


def payload(spark, *values):
    return spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "page int, value string")


def test_captured_answers(spark):
    node = {"id": "100", "slug": "demo", "name": "Demo", "description": "", "meta": {"description": "fallback"}}
    got = by(P.id_batches(spark, payload(spark, {"data": {"p100": node, "p101": None, "p102": {"id": "7", "slug": "x"}}}), 100, 103), "asked", "slug", "description", "outcome")
    assert got == {100: ("demo", "fallback", "found"), 101: (None, None, "unavailable"), 102: (None, None, "unavailable")}
    answers = {"data": {"p0": {"id": "100", "slug": "a", "product": {"id": "1", "slug": "Canonical"}}, "p1": {"id": "999", "slug": "b", "product": {"id": "2", "slug": "c"}}, "p2": None, "p3": {"id": "5", "slug": "d", "product": None}}}
    asked = payload(spark, answers).withColumn("asked", F.array(*(F.lit(x) for x in ("100", "101", "102", "d"))))
    assert by(P.launches(asked), "post_slug", "product_slug", "outcome") == {"100": ("canonical", "resolved"), "101": (None, "unavailable"), "102": (None, "unavailable"), "d": (None, "no_product")}
    search = payload(spark, {"data": {"search": {"edges": [{"node": {"id": "42", "slug": "first"}}, {"node": {"id": "43", "slug": "x"}}]}}}, {"data": {"search": {"edges": [{"node": {"id": "42", "slug": "later"}}]}}})
    assert by(P.search_pages(search), "product_id", "slug") == {42: ("later",), 43: ("x",)}
    pages = spark.createDataFrame([('<a href="/categories/ai-agents">x</a><a href="/categories/ai-agents?ref=y">x</a><a href="/products/z">z</a><a href="/categories/code-review-tools">c</a>',)], "html string")
    assert [r["category_slug"] for r in P.category_links(pages).orderBy("position").collect()] == ["ai-agents", "code-review-tools"]
    edges = [{"node": {"id": "1", "productsCount": 150, "products": {"edges": [{"node": {"id": "5", "slug": "e"}}]}}}, {"node": {"id": "2", "productsCount": 1, "products": {"edges": [{"node": {"id": "6", "slug": "f"}}]}}}]
    inside, over = P.collections(payload(spark, {"data": {"collections": {"edges": edges}}}))
    assert inside.count() == 2 and [tuple(r) for r in over.collect()] == [(1, 150, 100)]
