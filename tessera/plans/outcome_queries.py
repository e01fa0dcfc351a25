"""Whole rows after batches of fetches, recoveries and completions over the driver's tables, with SQL for each.

Customers are products and orders results: some ten for every customer, which lead to other slugs, drop products and put them anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import outcomes as O
from tessera.plans import recovery as R
from tessera.sources.binding import read

_PAGE = {
    "product_url": "concat('https://catalogue.example/products/', CAST(o_orderkey AS STRING))", "name": "concat('n', CAST(o_orderkey AS STRING))", "tagline": "CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END",
    "description": "CASE WHEN o_orderkey % 4 > 0 THEN concat('d', CAST(o_orderkey AS STRING)) END", "website_url": "CASE WHEN o_orderkey % 5 > 0 THEN concat('https://w', CAST(o_orderkey AS STRING)) END",
    "categories": "CASE WHEN o_orderkey % 6 > 0 THEN split(concat('a,', o_orderstatus), ',') END", "content_hash": "concat('h', CAST(o_orderkey AS STRING))",
}
#: name -> (table, condition, columns)
BOUND = {
    "products": (
        "customer", "c_custkey % 9 > 0",
        {"slug": "concat('p', CAST(c_custkey AS STRING))", "status": "CASE c_custkey % 3 WHEN 0 THEN 'fetched' WHEN 1 THEN 'unavailable' ELSE 'retry' END", "attempts": "CAST(c_custkey % 5 AS BIGINT)", "http_status": "CASE WHEN c_custkey % 3 = 1 THEN 404 ELSE 200 END",
         "next_retry_at": "CASE WHEN c_custkey % 3 = 2 THEN c_custkey END", "last_error": "CASE WHEN c_custkey % 3 = 1 THEN 'gone' END", "fetched_at": "CASE WHEN c_custkey % 3 = 0 THEN CAST(1 AS BIGINT) END", "product_url": "'old url'", "name": "c_name", "tagline": "c_mktsegment",
         "description": "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_name END", "website_url": "CAST(NULL AS STRING)", "categories": "split('old', ',')", "content_hash": "'old'", "source_lastmod": "c_custkey"},
    ),
    "aliases": ("customer", "c_custkey % 9 = 0", {"alias_slug": "concat('p', CAST(c_custkey AS STRING))", "canonical_slug": "concat('p', CAST(c_custkey % 100 + 1 AS STRING))", "http_status": "301"}),
    "results": (
        "orders", "o_orderkey % 8 <> 3",
        {"slug": "concat('p', CAST(o_custkey AS STRING))", "final_slug": "CASE WHEN o_orderkey % 13 = 0 THEN concat('p', CAST(o_custkey % 40 + 1 AS STRING)) WHEN o_orderkey % 17 = 0 THEN concat('m', CAST(o_custkey AS STRING)) ELSE concat('p', CAST(o_custkey AS STRING)) END",
         "outcome": "CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'O' THEN 'retry' ELSE 'unavailable' END", "attempt": "CAST(o_orderkey % 7 AS BIGINT)", "http_status": "CASE o_orderstatus WHEN 'F' THEN 200 ELSE 503 END", "error": "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END",
         "retry_at": "CASE WHEN o_orderstatus = 'O' THEN o_orderkey END", "capture_timestamp": "CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderkey AS STRING) END", "ordinal": "o_orderkey", **_PAGE},
    ),
    "recoveries": ("customer", "c_custkey % 2 = 1", {"slug": "concat('p', CAST(c_custkey AS STRING))", "outcome": "'claimed'", "attempts": "CAST(c_custkey % 9 AS BIGINT)", "capture_timestamp": "CAST(NULL AS STRING)", "http_status": "CAST(NULL AS INT)", "last_error": "'e'"}),
    "resolutions": ("orders", "o_orderkey % 2 = 0", {"post_slug": "concat('l', CAST(o_orderkey % 3000 AS STRING), '-', CAST(o_orderkey AS STRING))", "product_slug": "CAST(NULL AS STRING)", "outcome": "'unavailable'"}),
    "post_recoveries": ("orders", "o_orderkey % 4 = 0", {"post_slug": "concat('l', CAST(o_orderkey % 3000 AS STRING), '-', CAST(o_orderkey AS STRING))", "outcome": "'claimed'", "attempts": "CAST(3 AS BIGINT)", "capture_timestamp": "CAST(NULL AS STRING)", "http_status": "CAST(NULL AS INT)", "last_error": "'e'", "product_slug": "CAST(NULL AS STRING)"}),
    "post_results": (
        "orders", "o_orderkey % 5 > 0",
        {"post_slug": "concat('l', CAST(o_orderkey % 3000 AS STRING), '-', CAST(o_orderkey - o_orderkey % 3 AS STRING))", "slug": "concat('p', CAST(o_custkey * 2 AS STRING))", "outcome": "CASE o_orderstatus WHEN 'F' THEN 'recovered' ELSE 'parse_failed' END",
         "attempt": "CAST(o_orderkey % 7 AS BIGINT)", "http_status": "200", "error": "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END", "capture_timestamp": "CAST(o_orderkey AS STRING)", "ordinal": "o_orderkey", **_PAGE},
    ),
    "changes": ("orders", "true", {"slug": "concat('p', CAST(o_custkey AS STRING))", "crawl_id": "o_orderpriority", "outcome": "CASE WHEN o_orderkey % 2 = 0 THEN 'recovered' ELSE 'parse_failed' END", "attempt": "CAST(o_orderkey % 5 AS BIGINT)", "http_status": "CASE WHEN o_orderkey % 3 > 0 THEN 200 END", "error": "CASE WHEN o_orderkey % 2 = 1 THEN 'bad' END", "ordinal": "o_orderkey"}),
    "captures": ("customer", "true", {"slug": "concat('p', CAST(c_custkey AS STRING))", "crawl_id": "CASE WHEN c_custkey % 2 = 0 THEN '1-URGENT' ELSE '2-HIGH' END", "outcome": "'pending'", "attempts": "CAST(0 AS BIGINT)", "http_status": "CAST(NULL AS INT)", "last_error": "CAST(NULL AS STRING)"}),
}


def bound(spark: SparkSession, d: str, name: str) -> DataFrame:
    table, condition, columns = BOUND[name]
    return read(spark, d, table).where(condition).selectExpr(*(f"{x} AS {c}" for c, x in columns.items()))


def _with(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS (SELECT {', '.join(f'{x} AS {c}' for c, x in BOUND[n][2].items())} FROM {BOUND[n][0]} WHERE {BOUND[n][1]})" for n in names)


QUERIES, SQL = {}, {}


def query(*names: str, sql: str):
    """Register a function of the bound relations and the time with its SQL over them."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, d: _flat(f(*(bound(spark, d, n) for n in names), F.lit(9).cast("long")))
        SQL[f.__name__] = f"{_with(*names)} {sql}"
        return f

    return add


def _flat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("categories", F.array_join("categories", "|")) if "categories" in rows.columns else rows


_COPIED = ("product_url", "name", "tagline", "description", "website_url", "categories", "content_hash")


def _applied(results: str, products: str = "products") -> str:
    """The rows after `results` as SQL, step by step like the tables of one slug's events."""
    page = ", ".join(_COPIED)
    pages = ", ".join(f"last({c} ORDER BY ordinal) FILTER (live AND got) AS n_{c}" for c in _COPIED)
    copied = ", ".join(f"{f'''array_to_string(CASE WHEN copied THEN n_{c} WHEN kept THEN {c} END, '|')''' if c == 'categories' else f'CASE WHEN copied THEN n_{c} WHEN kept THEN {c} END'} AS {c}" for c in _COPIED)
    return f"""
ev AS (
  SELECT CASE WHEN got AND final_slug <> slug THEN final_slug ELSE slug END AS slug, CASE WHEN got AND final_slug <> slug THEN 'put' ELSE 'change' END AS what, ordinal, attempt, got, CASE WHEN got THEN 'fetched' ELSE outcome END AS s_status, http_status AS s_http,
    CASE WHEN NOT got THEN retry_at END AS s_retry, CASE WHEN NOT got THEN error END AS s_error, {page} FROM (SELECT *, outcome = 'fetched' AS got FROM {results})
  UNION ALL SELECT slug, 'drop', ordinal, NULL, false, NULL, NULL, NULL, NULL, {', '.join('NULL' for _ in _COPIED)} FROM {results} WHERE outcome = 'fetched' AND final_slug <> slug),
d1 AS (SELECT *, max(ordinal) FILTER (what = 'drop') OVER (PARTITION BY slug) AS dropped FROM ev),
d2 AS (SELECT *, min(ordinal) FILTER (what = 'put' AND (dropped IS NULL OR ordinal > dropped)) OVER (PARTITION BY slug) AS born FROM d1),
d3 AS (SELECT *, what <> 'drop' AND coalesce((dropped IS NULL AND slug IN (SELECT slug FROM {products})) OR ordinal >= born, false) AS live FROM d2),
su AS (
  SELECT slug AS e_slug, last(s_status ORDER BY ordinal) FILTER (live) AS s_status, last(s_http ORDER BY ordinal) FILTER (live) AS s_http, last(s_retry ORDER BY ordinal) FILTER (live) AS s_retry, last(s_error ORDER BY ordinal) FILTER (live) AS s_error,
    {pages}, coalesce(bool_or(live AND got), false) AS copied, max(attempt) FILTER (live AND what = 'put') AS most, bool_or(live) AS alive, max(dropped) IS NOT NULL AS anew FROM d3 GROUP BY slug),
rows_ AS (
  SELECT coalesce(slug, e_slug) AS slug, CASE WHEN e_slug IS NOT NULL THEN s_status ELSE status END AS status, CAST(coalesce(greatest(CASE WHEN kept THEN attempts END, most), 0) AS BIGINT) AS attempts, CASE WHEN e_slug IS NOT NULL THEN s_http ELSE http_status END AS http_status,
    CASE WHEN e_slug IS NOT NULL THEN s_retry ELSE next_retry_at END AS next_retry_at, CASE WHEN e_slug IS NOT NULL THEN s_error ELSE last_error END AS last_error, CAST(CASE WHEN copied THEN 9 WHEN kept THEN fetched_at END AS BIGINT) AS fetched_at, {copied},
    CASE WHEN kept THEN source_lastmod END AS source_lastmod
  FROM (SELECT p.*, su.*, p.slug IS NOT NULL AND NOT coalesce(anew, false) AS kept FROM {products} p FULL JOIN su ON p.slug = su.e_slug) WHERE e_slug IS NULL OR alive)"""


@query("products", "aliases", "results", sql=f", {_applied('results')} SELECT * FROM rows_")
def fetched_products(products, aliases, results, now):
    return O.apply_fetches(products, aliases, results, now)[0]


@query("products", "aliases", "results", sql="""
, l AS (SELECT slug, last(final_slug ORDER BY ordinal) AS final_slug, last(http_status ORDER BY ordinal) AS http_status FROM results WHERE outcome = 'fetched' AND final_slug <> slug GROUP BY slug)
SELECT coalesce(l.slug, alias_slug) AS alias_slug, coalesce(final_slug, canonical_slug) AS canonical_slug, CASE WHEN l.slug IS NULL THEN a.http_status ELSE l.http_status END AS http_status FROM aliases a FULL JOIN l ON alias_slug = l.slug""")  # fmt: skip
def fetched_aliases(products, aliases, results, now):
    return O.apply_fetches(products, aliases, results, now)[1]


def _as_recovered(results: DataFrame) -> DataFrame:
    return results.withColumn("outcome", F.when(F.col("outcome") == "fetched", "recovered").otherwise(F.col("outcome"))).drop("retry_at")


@query("products", "aliases", "recoveries", "results", sql=f", done AS (SELECT * REPLACE (NULL::BIGINT AS retry_at) FROM results WHERE outcome = 'fetched'), {_applied('done')} SELECT * FROM rows_")
def recovered_products(products, aliases, recoveries, results, now):
    return O.apply_recoveries(products, aliases, recoveries, _as_recovered(results), now)[0]


@query("products", "aliases", "recoveries", "results", sql="""
, f AS (
  SELECT slug, last(CASE WHEN outcome = 'fetched' THEN 'recovered' ELSE outcome END ORDER BY ordinal) AS outcome, max(attempt) AS attempts, arg_max_null(capture_timestamp, ordinal) AS capture_timestamp, last(http_status ORDER BY ordinal) AS http_status, arg_max_null(error, ordinal) AS error FROM results GROUP BY slug)
SELECT coalesce(f.slug, r.slug) AS slug, coalesce(f.outcome, r.outcome) AS outcome, greatest(f.attempts, r.attempts) AS attempts, f.capture_timestamp, f.http_status, CASE WHEN f.slug IS NULL THEN r.last_error ELSE f.error END AS last_error FROM recoveries r FULL JOIN f ON f.slug = r.slug""")  # fmt: skip
def recovered_rows(products, aliases, recoveries, results, now):
    return O.apply_recoveries(products, aliases, recoveries, _as_recovered(results), now)[2]


_POSTS = f"""
, g AS (SELECT r.*, CASE WHEN outcome = 'recovered' THEN coalesce(canonical_slug, slug) ELSE slug END AS product_slug, alias_slug FROM post_results r LEFT JOIN aliases ON alias_slug = slug),
mine AS (SELECT * FROM g WHERE outcome = 'recovered' AND alias_slug IS NULL),
every_ AS (SELECT * FROM products UNION ALL BY NAME SELECT DISTINCT slug, 'pending' AS status, CAST(0 AS BIGINT) AS attempts FROM mine WHERE slug NOT IN (SELECT slug FROM products)),
fills AS (SELECT * REPLACE ('fetched' AS outcome, NULL AS error), slug AS final_slug, NULL::BIGINT AS retry_at FROM mine WHERE slug NOT IN (SELECT slug FROM products WHERE status = 'fetched') QUALIFY row_number() OVER (PARTITION BY slug ORDER BY ordinal) = 1)"""


@query("products", "aliases", "resolutions", "post_recoveries", "post_results", sql=f"{_POSTS}, {_applied('fills', 'every_')} SELECT * FROM rows_")
def recovered_post_products(products, aliases, resolutions, recoveries, results, now):
    return O.apply_post_recoveries(products, aliases, resolutions, recoveries, results, now)[0]


@query("products", "aliases", "resolutions", "post_recoveries", "post_results", sql=f"""
{_POSTS}, t AS (SELECT post_slug, last(product_slug ORDER BY ordinal) AS p FROM g WHERE outcome = 'recovered' GROUP BY 1)
SELECT s.post_slug, coalesce(p, product_slug) AS product_slug, CASE WHEN p IS NULL THEN outcome ELSE 'resolved' END AS outcome FROM resolutions s LEFT JOIN t ON t.post_slug = s.post_slug""")  # fmt: skip
def recovered_post_resolutions(products, aliases, resolutions, recoveries, results, now):
    return O.apply_post_recoveries(products, aliases, resolutions, recoveries, results, now)[1]


@query("products", "aliases", "resolutions", "post_recoveries", "post_results", sql=f"""
{_POSTS}, f AS (
  SELECT post_slug, last(outcome ORDER BY ordinal) AS outcome, max(attempt) AS attempts, last(capture_timestamp ORDER BY ordinal) AS capture_timestamp, last(http_status ORDER BY ordinal) AS http_status, arg_max_null(error, ordinal) AS error, last(product_slug ORDER BY ordinal) AS product_slug FROM g GROUP BY 1)
SELECT coalesce(f.post_slug, r.post_slug) AS post_slug, coalesce(f.outcome, r.outcome) AS outcome, greatest(f.attempts, r.attempts) AS attempts, f.capture_timestamp, f.http_status, CASE WHEN f.post_slug IS NULL THEN r.last_error ELSE f.error END AS last_error, f.product_slug
FROM post_recoveries r FULL JOIN f ON f.post_slug = r.post_slug""")  # fmt: skip
def recovered_post_rows(products, aliases, resolutions, recoveries, results, now):
    return O.apply_post_recoveries(products, aliases, resolutions, recoveries, results, now)[2]


_WHOLE = "description IS NOT NULL AND (tagline IS NOT NULL OR website_url IS NOT NULL)"
_FILLS = f"""
, f AS (
  SELECT slug, last(name ORDER BY ordinal) AS name, last(tagline ORDER BY ordinal) FILTER (tagline IS NOT NULL) AS tagline, last(description ORDER BY ordinal) AS description, last(website_url ORDER BY ordinal) FILTER (website_url IS NOT NULL) AS website_url,
    last(categories ORDER BY ordinal) FILTER (len(categories) > 0) AS categories, last(content_hash ORDER BY ordinal) AS content_hash FROM results WHERE {_WHOLE} GROUP BY slug)"""


@query("products", "results", sql=f"""
{_FILLS}
SELECT p.slug, CASE WHEN f.slug IS NULL THEN status ELSE 'fetched' END AS status, attempts, CASE WHEN f.slug IS NULL THEN http_status ELSE 200 END AS http_status, CASE WHEN f.slug IS NULL THEN next_retry_at END AS next_retry_at, CASE WHEN f.slug IS NULL THEN last_error END AS last_error,
  CAST(CASE WHEN f.slug IS NULL THEN fetched_at ELSE 9 END AS BIGINT) AS fetched_at, product_url, coalesce(f.name, p.name) AS name, coalesce(f.tagline, p.tagline) AS tagline, coalesce(f.description, p.description) AS description, coalesce(f.website_url, p.website_url) AS website_url,
  array_to_string(coalesce(f.categories, p.categories), '|') AS categories, coalesce(f.content_hash, p.content_hash) AS content_hash, source_lastmod FROM products p LEFT JOIN f ON f.slug = p.slug""")  # fmt: skip
def completed_products(products, results, now):
    return O.apply_completions(products, results, now)[0]


@query("products", "results", sql=f"{_FILLS} SELECT count(*) AS newly_fetched FROM products JOIN f USING (slug) WHERE status <> 'fetched'")
def completed_count(products, results, now):
    return O.apply_completions(products, results, now)[1]


@query("captures", "changes", sql="""
, n AS (SELECT slug, crawl_id, last(outcome ORDER BY ordinal) AS outcome, last(attempt ORDER BY ordinal) AS attempt, arg_max_null(http_status, ordinal) AS http_status, arg_max_null(error, ordinal) AS error FROM changes GROUP BY 1, 2)
SELECT c.slug, c.crawl_id, coalesce(n.outcome, c.outcome) AS outcome, coalesce(n.attempt, c.attempts) AS attempts, n.http_status, n.error AS last_error FROM captures c LEFT JOIN n ON n.slug = c.slug AND n.crawl_id = c.crawl_id""")  # fmt: skip
def captures_after_repeats(captures, changes, now):
    return R.capture_outcomes(captures, changes).select("slug", "crawl_id", "outcome", "attempts", "http_status", "last_error")
