"""Page states: queries against SQL, refused batches, replays, and tables that are published together."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import page_queries
from tessera.plans import pages as P
from tessera.plans.store import CursorChanged, Store
from tests.test_mart import con, same  # noqa: F401

RECORDS = "array<struct<product_id:bigint,slug:string>>"
SEEN = "first_seen_at long, last_seen_at long"


@pytest.mark.parametrize("name", sorted(page_queries.QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):  # noqa: F811
    same(page_queries.QUERIES[name](spark, sf_dir).toPandas(), con.execute(page_queries.SQL[name]).df())


@pytest.mark.parametrize("name", ["pages_collection_report", "pages_overflow", "pages_overflow_pending", "pages_collection_scans", "pages_search_report"])
def test_a_batch_is_computed_once(spark, sf_dir, name):
    """What is checked, counted and merged reads the batch's written table, and gathers no line items again."""
    assert not any("lineitem" in f for f in page_queries.QUERIES[name](spark, sf_dir).inputFiles())


@pytest.fixture
def state(spark):
    make = spark.createDataFrame
    return {
        "source_products": make([(1, "a", 1, 1)], f"product_id long, slug string, {SEEN}"),
        "products": make([("a", "A", None)], "slug string, name string, tagline string"),
        "aliases": make([("old", "a")], "alias_slug string, canonical_slug string"),
        "category_scans": make([("x", 9, 3, 1, 0), ("y", 9, 3, 2, 1)], "category_slug string, total_count int, pages_count int, next_page int, pages_scanned long"),
        "category_candidates": make([], f"category_slug string, product_id long, slug string, new_product_id boolean, {SEEN}"),
        "collection_scans": make([("c", 9, 4, 1, 0, 0, 0, 0)], "scan_name string, total_count int, pages_count int, next_page int, pages_scanned long, collections_seen long, memberships_seen long, reported_memberships long"),
        "collection_candidates": make([], f"product_id long, slug string, new_product_id boolean, {SEEN}"),
        "collection_overflow": make([(7, 150, 100, 0)], "collection_id long, products_count int, next_offset int, pages_scanned long"),
        "search_scans": make([("q", 2, 1, 0, 0)], "query string, pages_count int, next_page int, requests long, pages_scanned long"),
        "search_candidates": make([], f"product_id long, slug string, name string, tagline string, new_product_id boolean, {SEEN}"),
    }


def category_pages(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"category_slug string, page int, records {RECORDS}, ordinal int")


def collection_pages(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"scan_name string, page int, collections array<struct<collection_id:bigint,products_count:int,records:{RECORDS}>>, ordinal int")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_categories(spark, state):
    pages = category_pages(spark, ("x", 1, [(1, "b"), (2, "c"), (2, "d"), (None, "e")]), ("y", 2, [(2, "old"), (3, "old")]))
    new, n = P.apply_categories(state, pages, F.lit(5).cast("long"))
    assert n == 2 and rows(new["category_candidates"]) == [("x", 1, "b", False, 5, 5), ("x", 2, "d", True, 5, 5), ("y", 2, "old", True, 5, 5), ("y", 3, "old", True, 5, 5)]
    assert rows(new["source_products"]) == [(1, "b", 1, 5), (2, "old", 5, 5), (3, "old", 5, 5)]
    assert {r["slug"] for r in new["products"].collect()} == {"a", "b"}  # an alias is no product
    assert rows(new["category_scans"]) == [("x", 9, 3, 2, 1), ("y", 9, 3, 3, 2)]
    with pytest.raises(CursorChanged):  # a replay changes nothing
        P.apply_categories(new, pages, F.lit(5).cast("long"))
    again, n = P.apply_categories(new, category_pages(spark, ("x", 2, [(2, "z")])), F.lit(5).cast("long"))
    assert n == 0 and ("x", 2, "z", True, 5, 5) in rows(again["category_candidates"])  # new stays new


@pytest.mark.parametrize("page", [("x", 2), ("unknown", 1)])
def test_one_wrong_cursor_refuses_the_batch(spark, state, page):
    with pytest.raises(CursorChanged):
        P.apply_categories(state, category_pages(spark, (*page, []), ("y", 2, [])), F.lit(5).cast("long"))
    with pytest.raises(CursorChanged):
        P.apply_categories(state, category_pages(spark, ("y", 2, []), ("y", 3, [])), F.lit(5).cast("long"))


def test_collections(spark, state):
    pages = collection_pages(spark, ("c", 2, [(8, 300, [(2, "b"), (3, "c")])]), ("c", 1, [(7, 120, [(1, "z"), (2, "y")]), (9, 10, [])]), ("c", 3, None))
    new, n = P.apply_collections(state, pages, F.lit(5).cast("long"))
    assert n == 2 and rows(new["collection_candidates"]) == [(1, "z", False, 5, 5), (2, "b", True, 5, 5), (3, "c", True, 5, 5)]
    assert rows(new["collection_overflow"]) == [(7, 150, 100, 0), (8, 300, 100, 0)] and rows(new["source_products"])[0] == (1, "a", 1, 1)
    assert rows(new["collection_scans"]) == [("c", 9, 4, 4, 3, 3, 4, 430)]
    over = spark.createDataFrame([(7, 100, [(4, "d")], 1), (8, 100, [(2, "b"), (5, "e")], 2)], f"collection_id long, offset int, records {RECORDS}, ordinal int")
    last, n = P.apply_overflow(new, over, F.lit(5).cast("long"), "c")
    assert n == 2 and rows(last["collection_overflow"]) == [(7, 150, 150, 1), (8, 300, 200, 1)] and rows(last["collection_scans"])[0][6] == 7
    assert rows(P.pending_overflow(last["collection_overflow"], 9)) == [(8, 200, 300)]
    with pytest.raises(CursorChanged):
        P.apply_overflow(last, over, F.lit(5).cast("long"), "c")


@pytest.mark.parametrize("numbers", [[1, 3], [2, 3], [0, 1], [1, 2, 4]])
def test_a_gap_refuses_the_batch(spark, state, numbers):
    with pytest.raises(CursorChanged):
        P.apply_collections(state, collection_pages(spark, *(("c", n, []) for n in numbers)), F.lit(5).cast("long"))


def test_searches(spark, state):
    steps = spark.createDataFrame([("q", 1, 3, 2)], "query string, expected_page int, next_page int, pages_scanned long")
    found = spark.createDataFrame([(1, "a2", None, "t", 1), (2, "b", "B", None, 2), (2, "b2", None, "T", 3), (4, "b2", "X", None, 4), (5, "old", "O", None, 5)], "product_id long, slug string, name string, tagline string, ordinal int")
    new, n = P.apply_searches(state, steps, found, F.lit(5).cast("long"))
    assert n == 3 and rows(new["search_candidates"])[:2] == [(1, "a2", None, "t", False, 5, 5), (2, "b2", "B", "T", True, 5, 5)]
    assert {tuple(r) for r in new["products"].collect()} == {("a", "A", None), ("b2", "B", "T")} and rows(new["search_scans"]) == [("q", 2, 3, 1, 2)]
    with pytest.raises(CursorChanged):
        P.apply_searches(new, steps, found, F.lit(5).cast("long"))


def test_prepare(spark, state):
    batch = lambda *r: spark.createDataFrame(r, "category_slug string, total_count int, pages_count int, ordinal int")
    got = P.prepared("category_scans", state["category_scans"], batch(("x", 5, 2, 1), ("x", 6, 1, 2), ("z", 1, 1, 1)))
    assert rows(got) == [("x", 6, 3, 1, 0), ("y", 9, 3, 2, 1), ("z", 1, 1, 1, 0)]
    assert [r["category_slug"] for r in P.pending_pages(got, 2).collect()] == ["x", "z"]
    for bad in (("", 1, 1, 1), (None, 1, 1, 1), ("x", -1, 1, 1), ("x", 1, None, 1)):
        with pytest.raises(ValueError):
            P.prepared("category_scans", state["category_scans"], batch(("y", 1, 1, 1), bad))


def test_empty_batches(spark, state):
    new, n = P.apply_categories(state, category_pages(spark, ("x", 1, [])).limit(0), F.lit(5).cast("long"))
    assert n == 0 and all(rows(new[t]) == rows(state[t]) for t in ("category_scans", "source_products", "category_candidates"))
    new, n = P.apply_collections(state, collection_pages(spark, ("c", 1, [])).limit(0), F.lit(5).cast("long"))
    assert n == 0 and rows(new["collection_scans"]) == rows(state["collection_scans"])


def test_tables_move_together(spark, state, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.snapshot() == 0 and store.tables() == {}
    first = store.publish(state, 0)
    new, _ = P.apply_categories(store.tables(), category_pages(spark, ("x", 1, [(2, "b")])), F.lit(5).cast("long"))
    changed = {t: new[t] for t in ("category_candidates", "source_products", "category_scans")}
    broken = changed | {"category_scans": changed["category_scans"].withColumn("next_page", F.raise_error(F.lit("lost")).cast("int"))}
    before = {str(p) for p in tmp_path.rglob("*.parquet")}
    with pytest.raises(Exception, match="lost"):  # after two tables are written
        store.publish(broken, first)
    assert store.snapshot() == first and rows(store.tables()["category_candidates"]) == [] and {str(p) for p in tmp_path.rglob("*.parquet")} == before
    old = store.tables()
    second = store.publish(changed, first)
    assert rows(store.tables()["category_candidates"]) == [("x", 2, "b", True, 5, 5)] and rows(store.tables()["category_scans"])[0] == ("x", 9, 3, 2, 1)
    assert rows(old["category_candidates"]) == [] and rows(store.tables(first)["category_scans"])[0] == ("x", 9, 3, 1, 0)  # readers keep theirs
    assert store.folders()["aliases"] == store.folders(first)["aliases"]
    with pytest.raises(CursorChanged):
        store.publish(changed, first)
    assert store.snapshot() == second


def test_two_writers(spark, state, tmp_path):
    store = Store(spark, str(tmp_path))
    store.publish({"aliases": state["aliases"]}, 0)
    late = Store(spark, str(tmp_path))
    late.snapshot = lambda: 0  # it looked before the other one published
    late.folders = lambda snapshot=None: {}
    with pytest.raises(CursorChanged):
        late.publish({"aliases": state["aliases"].limit(0)}, 0)
    assert store.snapshot() == 1 and store.tables()["aliases"].count() == 1
