"""Page states of searches, categories and collections: prepare, pending, apply and report.

A state is a dict of tables; `apply_*` takes it with a batch of pages and gives (new tables, number of new ids). Nothing is
published here: `Store.publish` puts the new tables in place together, so that cursors and memberships move at once or not at all.

A batch names the position that it was read from. If any page isn't its scan's next one, or a run of pages has a gap, the whole batch is
refused, so a replay changes nothing. Rows of a batch carry `ordinal`; where a product comes more than once the last one's values count.

A batch's pages, and the products found in it, are written to the job's own folder once; what is checked, counted and merged is read from there,
so that no step computes an earlier one again.

Tables:
  search_scans      query, pages_count, next_page, requests, pages_scanned
  search_candidates product_id, slug, name, tagline, new_product_id, first_seen_at, last_seen_at
  category_scans    category_slug, total_count, pages_count, next_page, pages_scanned
  category_candidates   category_slug, product_id, slug, new_product_id, first_seen_at, last_seen_at
  collection_scans  scan_name, total_count, pages_count, next_page, pages_scanned, collections_seen, memberships_seen, reported_memberships
  collection_candidates product_id, slug, new_product_id, first_seen_at, last_seen_at
  collection_overflow   collection_id, products_count, next_offset, pages_scanned
  source_products   product_id, slug, first_seen_at, last_seen_at
  products          slug and any other columns; aliases alias_slug, canonical_slug
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import merge as M
from tessera.operators.merge import fold, insert_missing
from tessera.plans.store import CursorChanged
from tessera.sources.scratch import written

State = dict[str, DataFrame]
#: Products that a collection lists in its own page; the others come by overflow pages of as many.
INLINE = 100
_FIRST_PAGE = {"search_scans": 1, "category_scans": 1, "collection_scans": 0}
_COUNTERS = ("requests", "pages_scanned", "collections_seen", "memberships_seen", "reported_memberships")


def merge(current: DataFrame, batch: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """A keyed merge that keeps the columns in their order."""
    return M.merge(current, batch, key, rules).select(*current.columns)


def prepared(kind: str, scans: DataFrame, batch: DataFrame) -> DataFrame:
    """Scans with those of the batch (key, pages_count, total_count where the table has one): new ones begin, known ones never lose pages.

    A blank key or a negative count is an error and nothing is prepared.
    """
    key = scans.columns[0]
    counts = [c for c in ("total_count", "pages_count") if c in scans.columns]
    bad = batch.where((F.coalesce(F.col(key), F.lit("")) == "") | reduce(lambda a, b: a | b, (F.col(c).isNull() | (F.col(c) < 0) for c in counts))).limit(1).count()
    if bad:
        raise ValueError(f"invalid state of {kind}: a blank name or a negative count")
    rules = {c: {"total_count": "last", "pages_count": "max"}[c] for c in counts}
    merged = merge(scans, fold(batch, key, rules, "ordinal"), key, rules)
    begun = {c: F.coalesce(F.col(c), F.lit(0).cast(scans.schema[c].dataType)) for c in _COUNTERS if c in scans.columns}
    begun["next_page"] = F.coalesce("next_page", F.lit(_FIRST_PAGE[kind]).cast(scans.schema["next_page"].dataType))
    return merged.withColumns(begun).select(*scans.columns)


def pending_pages(scans: DataFrame, limit: int) -> DataFrame:
    """(key, next_page): the next page of every scan that has one left, least advanced first."""
    key = scans.columns[0]
    return scans.where("next_page <= pages_count").select(key, "next_page").orderBy("next_page", key).limit(limit)


def pending_run(scans: DataFrame, limit: int) -> DataFrame:
    """(key, page): the next `limit` pages of every scan, whose pages are numbered from 0."""
    key = scans.columns[0]
    last = F.least(F.col("pages_count"), F.col("next_page") + limit) - 1
    return scans.where("next_page < pages_count").select(key, F.explode(F.sequence("next_page", last)).alias("page"))


def pending_overflow(overflow: DataFrame, limit: int) -> DataFrame:
    """(collection_id, next_offset, products_count) of collections that aren't read to their end."""
    return overflow.where("next_offset < products_count").select("collection_id", "next_offset", "products_count").orderBy("next_offset", "collection_id").limit(limit)


def page_runs(pages: DataFrame, key: str, page: str = "page") -> DataFrame:
    """(key, first, last, pages): the runs of consecutive pages of every scan, a page that comes twice counted once."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(page))
    islands = pages.select(key, page).distinct().withColumn("island", F.col(page) - place)
    return islands.groupBy(key, "island").agg(F.min(page).alias("first"), F.max(page).alias("last"), F.count(F.lit(1)).alias("pages")).drop("island")


def _refuse_unless_next(scans: DataFrame, runs: DataFrame, key: str, cursor: str, what: str) -> None:
    """Every key must have one run, and it must begin at the key's cursor."""
    each = runs.groupBy(key).agg(F.count(F.lit(1)).alias("_runs"), F.min("first").alias("_first"))
    wrong = each.join(scans.select(key, F.col(cursor).alias("_cursor")), key, "left").where(F.col("_cursor").isNull() | (F.col("_cursor") != F.col("_first")) | (F.col("_runs") > 1))
    found = wrong.agg(F.count(F.lit(1)), F.min(F.col(key).cast("string"))).first()
    if found[0]:
        raise CursorChanged(f"{what} cursor changed: {found[0]} scans stand elsewhere, {found[1]} among them")


def _seen(state: State, found: DataFrame, now: Column) -> DataFrame:
    """Products found (product_id, slug, ..., ordinal), once for each id, with new_product_id, first_seen_at and last_seen_at."""
    known = state["source_products"].select(F.col("product_id"), F.lit(False).alias("new_product_id"))
    rows = found.join(known, "product_id", "left")
    return rows.withColumns({"new_product_id": F.coalesce("new_product_id", F.lit(True)), "first_seen_at": now, "last_seen_at": now})


def _new_products(state: State, found: DataFrame) -> DataFrame:
    """Products with the slugs that are neither known nor aliases; `found` holds a slug once, and columns of products."""
    aliases = state["aliases"].select(F.col("alias_slug").alias("slug"))
    return state["products"].unionByName(insert_missing(state["products"], found, "slug", aliases), allowMissingColumns=True)


def _once(rows: DataFrame, key: str, others: list[str]) -> DataFrame:
    return fold(rows, key, {c: "last" for c in others}, "ordinal")


def apply_categories(state: State, pages: DataFrame, now: Column) -> tuple[State, int]:
    """pages: category_slug, page, records array<struct<product_id, slug>>, ordinal; one page of a category at a time.

    A membership's new mark stays once set; source products and their slugs follow the last record.
    """
    key = "category_slug"
    listed = written(pages.select(key, "page", F.col("ordinal").alias("o"), F.posexplode_outer("records").alias("i", "r")).select(key, "page", "o", "i", "r.product_id", "r.slug"), "records")
    _refuse_unless_next(state["category_scans"], listed.groupBy(key, F.col("page").alias("first")).agg(F.count(F.lit(1)).alias("pages")), key, "next_page", "category scan")
    each = listed.where("product_id IS NOT NULL").select(key, F.struct("o", "i").alias("ordinal"), "product_id", "slug")
    products = written(_seen(state, _once(each, "product_id", ["slug"]), now), "found")
    marks = products.select("product_id", "new_product_id")
    rows = each.groupBy(key, "product_id").agg(F.max_by("slug", "ordinal").alias("slug")).join(marks, "product_id").withColumns({"first_seen_at": now, "last_seen_at": now})
    pair = F.struct(key, "product_id")
    rules = {"slug": "last", "new_product_id": "any", "first_seen_at": "min", "last_seen_at": "max"}
    current = state["category_candidates"]
    candidates = M.merge(current.withColumn("_pair", pair).drop(key, "product_id"), rows.withColumn("_pair", pair), "_pair", rules).select("_pair.*", *rules).select(*current.columns)
    sources = merge(state["source_products"], products, "product_id", {"slug": "last", "first_seen_at": "min", "last_seen_at": "max"})
    steps = listed.select(key, (F.col("page") + 1).alias("next_page"), F.lit(1).alias("pages_scanned")).distinct()
    scans = merge(state["category_scans"], steps, key, {"next_page": "max", "pages_scanned": "sum"})
    new = {"category_candidates": candidates, "source_products": sources, "products": _new_products(state, products.select("slug").distinct()), "category_scans": scans}
    return state | new, marks.where("new_product_id").count()


def _collected(state: State, records: DataFrame, now: Column) -> tuple[State, int]:
    """Candidates, source products and products with the records (product_id, slug, ordinal) that they lack; known rows stay as they are."""
    found = written(_seen(state, _once(records, "product_id", ["slug"]), now), "found")
    fresh = found.where("new_product_id")
    candidates = state["collection_candidates"].unionByName(insert_missing(state["collection_candidates"], found, "product_id"))
    sources = state["source_products"].unionByName(fresh.select(*state["source_products"].columns))
    return {"collection_candidates": candidates, "source_products": sources, "products": _new_products(state, fresh.select("slug").distinct())}, fresh.count()


def apply_collections(state: State, pages: DataFrame, now: Column) -> tuple[State, int]:
    """pages: scan_name, page, collections array<struct<collection_id, products_count, records array<struct<product_id, slug>>>>, ordinal.

    A batch may hold a run of pages for every scan; it must begin where the scan stands and have no gap. Records count in order of scan, page and place. Collections of more than INLINE
    products get an overflow row, or a larger count in theirs.
    """
    key = "scan_name"
    once = pages.groupBy(key, "page").agg(F.max_by("collections", "ordinal").alias("collections"))
    each = once.select(key, "page", F.posexplode_outer("collections").alias("i", "c")).select(key, "page", "i", F.col("c").isNotNull().alias("listed"), "c.collection_id", "c.products_count", "c.records")
    each = written(each.withColumn("members", F.when(F.col("records").isNotNull(), F.size("records"))), "collections")
    _refuse_unless_next(state["collection_scans"], page_runs(each, key), key, "next_page", "collection scan")
    records = each.select(key, "page", "i", F.posexplode("records").alias("j", "r")).select(F.struct(key, "page", "i", "j").alias("ordinal"), "r.product_id", "r.slug").where("product_id IS NOT NULL")
    new, n = _collected(state, records, now)
    large = each.where(F.col("products_count") > INLINE).groupBy("collection_id").agg(F.max("products_count").alias("products_count"))
    kind = state["collection_overflow"].schema
    over = merge(state["collection_overflow"], large, "collection_id", {"products_count": "max"})
    over = over.withColumns({"next_offset": F.coalesce("next_offset", F.lit(INLINE).cast(kind["next_offset"].dataType)), "pages_scanned": F.coalesce("pages_scanned", F.lit(0).cast(kind["pages_scanned"].dataType))})
    sums = each.groupBy(key).agg(
        F.count_if("listed").alias("collections_seen"), F.coalesce(F.sum("members"), F.lit(0)).alias("memberships_seen"),
        F.coalesce(F.sum("products_count"), F.lit(0)).alias("reported_memberships"), F.count_distinct("page").alias("pages_scanned"), (F.max("page") + 1).alias("next_page"),
    )
    rules = {"next_page": "max"} | {c: "sum" for c in ("pages_scanned", "collections_seen", "memberships_seen", "reported_memberships")}
    scans = merge(state["collection_scans"], sums, key, rules)
    return state | new | {"collection_overflow": over, "collection_scans": scans}, n


def apply_overflow(state: State, pages: DataFrame, now: Column, scan_name: str) -> tuple[State, int]:
    """pages: collection_id, offset, records array<struct<product_id, slug>>, ordinal: the next INLINE products of collections.

    Offsets stop at the collection's count. Memberships are counted in the scan `scan_name`.
    """
    key = "collection_id"
    once = written(pages.groupBy(key, "offset").agg(F.max_by("records", "ordinal").alias("records")), "overflow")
    _refuse_unless_next(state["collection_overflow"], once.select(key, F.col("offset").alias("first")), key, "next_offset", "collection overflow")
    records = once.select(key, "offset", F.posexplode("records").alias("i", "r")).select(F.struct("offset", key, "i").alias("ordinal"), "r.product_id", "r.slug").where("product_id IS NOT NULL")
    new, n = _collected(state, records, now)
    steps = once.select(F.col(key).alias("_k"), F.col("offset").alias("_at"))
    over = state["collection_overflow"].join(steps, F.col(key) == F.col("_k"), "left")
    hit = F.col("_k").isNotNull()
    over = over.withColumns({"next_offset": F.when(hit, F.least(F.col("products_count"), F.col("_at") + INLINE)).otherwise(F.col("next_offset")), "pages_scanned": F.col("pages_scanned") + hit.cast("int")}).drop("_k", "_at")
    read = once.agg(F.coalesce(F.sum(F.size("records")), F.lit(0)).alias("n")).select(F.lit(scan_name).alias("scan_name"), F.col("n").alias("memberships_seen"))
    known = read.join(state["collection_scans"].select("scan_name"), "scan_name", "left_semi")
    scans = merge(state["collection_scans"], known, "scan_name", {"memberships_seen": "sum"})
    return state | new | {"collection_overflow": over, "collection_scans": scans}, n


def apply_searches(state: State, steps: DataFrame, records: DataFrame, now: Column) -> tuple[State, int]:
    """steps: query, expected_page, next_page, pages_scanned, once for each query. records: product_id, slug, name, tagline, ordinal. Of new ids with one slug the smallest names the product.

    Candidates get the last slug, and name and tagline where they are set; a known candidate's new mark stays. New ids become source products and
    products with name and tagline.
    """
    key = "query"
    _refuse_unless_next(state["search_scans"], steps.select(key, F.col("expected_page").alias("first")), key, "next_page", "search scan")
    rules = {"slug": "last", "name": "last_set", "tagline": "last_set"}
    found = written(_seen(state, fold(records.where("product_id IS NOT NULL"), "product_id", rules, "ordinal"), now), "found")
    candidates = merge(state["search_candidates"], found, "product_id", rules | {"new_product_id": "keep", "first_seen_at": "min", "last_seen_at": "max"})
    fresh = found.where("new_product_id")
    sources = state["source_products"].unionByName(fresh.select(*state["source_products"].columns))
    by_slug = fold(fresh.withColumn("_o", -F.col("product_id")), "slug", {"name": "last", "tagline": "last"}, "_o")
    moved = steps.select(F.col(key), "next_page", F.lit(1).alias("requests"), "pages_scanned")
    scans = merge(state["search_scans"], moved, key, {"next_page": "last", "requests": "sum", "pages_scanned": "sum"})
    return state | {"search_candidates": candidates, "source_products": sources, "products": _new_products(state, by_slug), "search_scans": scans}, fresh.count()


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _report(*parts: tuple[DataFrame, dict[str, Column]]) -> DataFrame:
    """(name, n): every number of every part, each part one aggregation."""
    out = [rows.agg(*(c.cast("long").alias(n) for n, c in numbers.items())).select(F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("n")) for n in numbers))).alias("x")).select("x.*") for rows, numbers in parts]
    return reduce(DataFrame.unionByName, out)


def search_report(state: State) -> DataFrame:
    return _report(
        (state["search_candidates"], {"unique_candidates": F.count(F.lit(1)), "new_product_ids": F.count_if("new_product_id")}),
        (state["search_scans"], {"queries": F.count(F.lit(1)), "queries_complete": F.count_if(F.col("next_page") > F.col("pages_count")), "pages_scanned": _total("pages_scanned")}),
    )


def category_report(state: State) -> DataFrame:
    new = F.count_distinct(F.when(F.col("new_product_id"), F.col("product_id")))
    return _report(
        (state["category_candidates"], {"memberships": F.count(F.lit(1)), "unique_candidates": F.count_distinct("product_id"), "new_product_ids": new}),
        (state["category_scans"], {"categories": F.count(F.lit(1)), "categories_complete": F.count_if(F.col("next_page") > F.col("pages_count")), "pages_scanned": _total("pages_scanned"), "reported_memberships": _total("total_count")}),
    )


def collection_report(state: State) -> DataFrame:
    scans = {"collections_reported": "total_count", "root_pages_scanned": "pages_scanned", "collections_scanned": "collections_seen", "memberships_seen": "memberships_seen", "reported_memberships": "reported_memberships"}
    return _report(
        (state["collection_candidates"], {"unique_candidates": F.count(F.lit(1)), "new_product_ids": F.count_if("new_product_id")}),
        (state["collection_scans"], {n: _total(c) for n, c in scans.items()} | {"scans_complete": F.count_if(F.col("next_page") >= F.col("pages_count"))}),
        (state["collection_overflow"], {"overflow_collections": F.count(F.lit(1)), "overflow_complete": F.count_if(F.col("next_offset") >= F.col("products_count")), "overflow_pages_scanned": _total("pages_scanned")}),
    )
