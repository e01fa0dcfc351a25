"""Recovery transactions, queues and reports over the driver's tables, with SQL for each.

The input relations are bound once, by expressions that Spark and DuckDB read alike; customers stand for products,
orders for batches and events for archived slugs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import recovery as R
from tessera.sources.binding import read

_SLUG = "CASE WHEN c_custkey % 13 = 0 THEN concat('P-', CAST(c_custkey AS STRING)) ELSE concat('p', CAST(c_custkey AS STRING)) END"
_POST = "CASE WHEN event_id % 11 = 0 THEN concat('x!', CAST(event_id AS STRING)) WHEN event_id % 7 = 0 THEN CAST(event_id AS STRING) ELSE concat('p', CAST(event_id AS STRING)) END"
#: name -> (table, condition, columns)
BOUND = {
    "products": (
        "customer", "c_custkey % 9 > 0",
        {"slug": _SLUG, "name": "CASE WHEN c_custkey % 17 > 0 THEN c_name END", "tagline": "CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment WHEN c_custkey % 8 = 0 THEN '' END",
         "description": "CASE WHEN c_custkey % 5 > 0 THEN c_name ELSE '' END", "website_url": "CASE WHEN c_custkey % 3 > 0 THEN concat('https://s', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 10 = 0 THEN '.catalogue.example/' ELSE '.example/x' END) END",
         "status": "CASE c_custkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'retry' ELSE 'fetched' END", "attempts": "CAST(c_custkey % 5 AS BIGINT)",
         "http_status": "CASE WHEN c_custkey % 6 = 1 THEN 404 ELSE 200 END", "content_hash": "'old'", "next_retry_at": "CASE WHEN c_custkey % 12 = 2 THEN c_custkey END", "last_error": "CASE WHEN c_custkey % 6 = 1 THEN 'gone' END"},
    ),
    "aliases": ("customer", "c_custkey % 9 = 0", {"alias_slug": _SLUG, "canonical_slug": "concat('p', CAST(c_custkey % 100 + 1 AS STRING))"}),
    "recoveries": (
        "customer", "c_custkey % 3 = 1",
        {"slug": _SLUG, "outcome": "CASE c_custkey % 4 WHEN 0 THEN 'claimed' WHEN 1 THEN 'retry' WHEN 2 THEN 'recovered' ELSE 'not_found' END", "attempts": "CAST(c_custkey % 7 AS BIGINT)",
         "http_status": "200", "last_error": "CASE WHEN c_custkey % 4 = 1 THEN 'timeout' END"},
    ),
    "recovered": (
        "orders", "o_orderkey % 3 = 0",
        {"slug": "concat('p', CAST(o_custkey AS STRING))", "final_slug": "concat('p', CAST(o_custkey AS STRING))", "outcome": "CASE o_orderstatus WHEN 'F' THEN 'recovered' WHEN 'O' THEN 'retry' ELSE 'not_found' END",
         "attempt": "CAST(o_orderkey % 8 AS BIGINT)", "http_status": "CASE o_orderstatus WHEN 'F' THEN 200 ELSE 503 END", "error": "CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END",
         "name": "CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS STRING) END", "tagline": "o_orderpriority", "description": "CAST(NULL AS STRING)", "website_url": "CAST(NULL AS STRING)", "ordinal": "o_orderkey"},
    ),
    "candidates": ("events", "true", {"path_kind": "CASE WHEN event_id % 3 = 0 THEN 'products' ELSE 'posts' END", "slug": _POST, "first_seen_at": "CAST(1 AS BIGINT)", "last_seen_at": "CAST(1 AS BIGINT)"}),
    "resolutions": ("events", "event_id % 4 = 0", {"post_slug": _POST, "product_slug": "CAST(NULL AS STRING)", "outcome": "CASE WHEN event_id % 8 = 0 THEN 'unavailable' ELSE 'no_product' END"}),
    "post_recoveries": ("events", "event_id % 16 = 0", {"post_slug": _POST, "outcome": "CASE WHEN event_id % 32 = 0 THEN 'retry' ELSE 'parse_failed' END", "attempts": "CAST(event_id % 5 AS BIGINT)", "last_error": "'e'", "http_status": "500", "product_slug": "CAST(NULL AS STRING)"}),
    "source_ids": ("orders", "o_orderkey % 2 = 1", {"product_id": "o_orderkey", "slug": "concat('p', CAST(o_custkey AS STRING))"}),
    "external": (
        "customer", "c_custkey % 2 = 1",
        {"slug": _SLUG, "name": "concat('ext ', c_name)", "tagline": "CASE WHEN c_custkey % 5 > 1 THEN c_mktsegment END", "description": "CASE WHEN c_custkey % 7 > 2 THEN c_name END", "website_url": "CASE WHEN c_custkey % 11 > 0 THEN 'https://e.example' END"},
    ),
    "records": (
        "customer", "c_custkey % 4 = 1 AND c_custkey % 9 <> 4",
        {"slug": _SLUG, "name": "concat('cat ', c_name)", "tagline": "CAST(NULL AS STRING)", "description": "CASE WHEN c_custkey % 3 > 0 THEN 'd' END", "website_url": "CASE WHEN c_custkey % 5 > 0 THEN 'https://c.example' END", "content_hash": "'new'"},
    ),
    "captures": ("events", "event_id % 5 = 0", {"slug": _POST, "crawl_id": "event_type", "outcome": "CASE WHEN event_id % 10 = 0 THEN 'pending' ELSE 'fetch_failed' END", "attempts": "CAST(event_id % 3 AS BIGINT)", "http_status": "CAST(NULL AS INT)", "last_error": "CAST(NULL AS STRING)"}),
    "capture_changes": ("events", "event_id % 7 = 0", {"slug": _POST, "crawl_id": "event_type", "outcome": "CASE WHEN event_id % 2 = 0 THEN 'recovered' ELSE 'parse_failed' END", "attempt": "CAST(event_id % 3 + 1 AS BIGINT)", "http_status": "200", "error": "CASE WHEN event_id % 2 = 1 THEN 'bad' END"}),
    "enrichments": ("customer", "c_custkey % 8 = 4", {"slug": _SLUG, "outcome": "CASE WHEN c_custkey % 16 = 4 THEN 'retry' ELSE 'applied' END", "attempts": "CAST(c_custkey % 3 AS BIGINT)"}),
    "lookups": (
        "orders", "o_orderkey % 10 = 1",
        {"slug": "concat('p', CAST(o_custkey AS STRING))", "product_id": "CASE WHEN o_custkey % 4 > 0 THEN o_orderkey END", "final_slug": "concat('p', CAST(o_custkey AS STRING))", "name": "CAST(o_orderkey AS STRING)", "tagline": "CAST(NULL AS STRING)",
         "description": "CAST(NULL AS STRING)", "website_url": "CAST(NULL AS STRING)", "ordinal": "o_orderkey"},
    ),
    "post_results": (
        "events", "event_id % 6 = 1",
        {"post_slug": _POST, "slug": "concat('p', CAST(event_id % 400 AS STRING))", "outcome": "CASE WHEN event_id % 5 > 0 THEN 'recovered' ELSE 'not_found' END", "attempt": "CAST(event_id % 4 AS BIGINT)", "http_status": "200", "error": "CAST(NULL AS STRING)",
         "name": "concat('n', CAST(event_id AS STRING))", "tagline": "event_type", "description": "CAST(NULL AS STRING)", "website_url": "CAST(NULL AS STRING)", "ordinal": "event_id"},
    ),
}


def bound(spark: SparkSession, d: str, name: str) -> DataFrame:
    table, condition, columns = BOUND[name]
    return read(spark, d, table).where(condition).selectExpr(*(f"{x} AS {c}" for c, x in columns.items()))


def _with(*names: str) -> str:
    """The bound relations as SQL."""
    return "WITH " + ", ".join(f"{n} AS (SELECT {', '.join(f'{x} AS {c}' for c, x in BOUND[n][2].items())} FROM {BOUND[n][0]} WHERE {BOUND[n][1]})" for n in names)


QUERIES, SQL = {}, {}


def query(*names: str, sql: str):
    """Register a function of the bound relations with its SQL over them."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, d: f(*(bound(spark, d, n) for n in names))
        SQL[f.__name__] = f"{_with(*names)} {sql}"
        return f

    return add


@query("products", "recoveries", sql=r"""
SELECT p.slug, coalesce(r.attempts, 0) + 1 AS attempt FROM products p LEFT JOIN recoveries r ON r.slug = p.slug
WHERE p.status = 'unavailable' AND regexp_matches(p.slug, '^[a-z0-9]([a-z0-9._-]*[a-z0-9])?$') AND coalesce(r.attempts, 0) < 4 AND (r.slug IS NULL OR r.outcome IN ('claimed', 'retry'))
ORDER BY p.slug LIMIT 40""")  # fmt: skip
def recovery_claims(products, recoveries):
    return R.claim_recoveries(products, recoveries, 4, 40)


@query("products", "recoveries", sql=r"""
, c AS (SELECT p.slug, coalesce(r.attempts, 0) + 1 AS attempt FROM products p LEFT JOIN recoveries r ON r.slug = p.slug
  WHERE p.status = 'unavailable' AND regexp_matches(p.slug, '^[a-z0-9]([a-z0-9._-]*[a-z0-9])?$') AND coalesce(r.attempts, 0) < 4 AND (r.slug IS NULL OR r.outcome IN ('claimed', 'retry')))
SELECT slug, outcome, attempts, last_error FROM recoveries WHERE slug NOT IN (SELECT slug FROM c) UNION ALL SELECT slug, 'claimed', attempt, NULL FROM c""")  # fmt: skip
def recovery_claimed(products, recoveries):
    return R.claimed(recoveries, R.claim_recoveries(products, recoveries, 4, 1 << 30), "slug").select("slug", "outcome", "attempts", "last_error")


@query("candidates", "resolutions", "post_recoveries", sql=r"""
SELECT DISTINCT a.slug AS post_slug, coalesce(r.attempts, 0) + 1 AS attempt FROM candidates a JOIN resolutions s ON s.post_slug = a.slug LEFT JOIN post_recoveries r ON r.post_slug = a.slug
WHERE a.path_kind = 'posts' AND s.outcome = 'unavailable' AND regexp_matches(a.slug, '^[a-z0-9][a-z0-9_-]*$') AND NOT regexp_matches(a.slug, '^[0-9]+$') AND coalesce(r.attempts, 0) < 4
  AND (r.post_slug IS NULL OR r.outcome IN ('claimed', 'retry')) ORDER BY 1 LIMIT 50""")  # fmt: skip
def recovery_post_claims(candidates, resolutions, recoveries):
    return R.claim_post_recoveries(candidates, resolutions, recoveries, 4, 50)


_FOLDED = """f AS (SELECT slug, last(outcome ORDER BY ordinal) AS outcome, max(attempt) AS attempt, last(http_status ORDER BY ordinal) AS http_status, last(error ORDER BY ordinal) AS error FROM recovered GROUP BY slug)"""


@query("recoveries", "products", "aliases", "recovered", sql=f"""
, {_FOLDED}
SELECT coalesce(r.slug, f.slug) AS slug, CASE WHEN f.slug IS NULL THEN r.outcome ELSE f.outcome END AS outcome, greatest(r.attempts, f.attempt) AS attempts,
  CASE WHEN f.slug IS NULL THEN r.http_status ELSE f.http_status END AS http_status, CASE WHEN f.slug IS NULL THEN r.last_error ELSE f.error END AS last_error
FROM recoveries r FULL JOIN f ON r.slug = f.slug""")  # fmt: skip
def recovery_outcomes(recoveries, products, aliases, results):
    return R.apply_recoveries(products, aliases, recoveries, results)[2].select("slug", "outcome", "attempts", "http_status", "last_error")


@query("recoveries", "products", "aliases", "recovered", sql="""
, f AS (SELECT slug, last(name ORDER BY ordinal) FILTER (name IS NOT NULL) AS name, last(tagline ORDER BY ordinal) AS tagline FROM recovered WHERE outcome = 'recovered' GROUP BY slug)
SELECT coalesce(p.slug, f.slug) AS slug, CASE WHEN f.slug IS NULL THEN status ELSE 'fetched' END AS status, coalesce(f.name, p.name) AS name, coalesce(f.tagline, p.tagline) AS tagline, description
FROM products p FULL JOIN f ON p.slug = f.slug""")  # fmt: skip
def recovery_products(recoveries, products, aliases, results):
    return R.apply_recoveries(products, aliases, recoveries, results)[0].select("slug", "status", "name", "tagline", "description")


_POSTS = """, g AS (SELECT r.*, a.alias_slug, coalesce(a.canonical_slug, r.slug) AS target FROM post_results r LEFT JOIN aliases a ON a.alias_slug = r.slug),
n AS (SELECT slug, first(name ORDER BY ordinal) AS name, first(tagline ORDER BY ordinal) AS tagline FROM g WHERE outcome = 'recovered' AND alias_slug IS NULL AND slug NOT IN (SELECT slug FROM products WHERE status = 'fetched') GROUP BY slug)"""


@query("products", "aliases", "resolutions", "post_recoveries", "post_results", sql=f"""
{_POSTS}
SELECT coalesce(p.slug, n.slug) AS slug, CASE WHEN n.slug IS NULL THEN status ELSE 'fetched' END AS status, coalesce(n.name, p.name) AS name, coalesce(n.tagline, p.tagline) AS tagline
FROM products p FULL JOIN n ON p.slug = n.slug""")  # fmt: skip
def recovery_post_products(products, aliases, resolutions, recoveries, results):
    return R.apply_post_recoveries(products, aliases, resolutions, recoveries, results)[0].select("slug", "status", "name", "tagline")


@query("products", "aliases", "resolutions", "post_recoveries", "post_results", sql=f"""
{_POSTS}
, t AS (SELECT post_slug, last(target ORDER BY ordinal) AS target FROM g WHERE outcome = 'recovered' GROUP BY post_slug)
SELECT s.post_slug, CASE WHEN t.post_slug IS NULL THEN product_slug ELSE target END AS product_slug, CASE WHEN t.post_slug IS NULL THEN outcome ELSE 'resolved' END AS outcome
FROM resolutions s LEFT JOIN t ON s.post_slug = t.post_slug""")  # fmt: skip
def recovery_post_resolutions(products, aliases, resolutions, recoveries, results):
    return R.apply_post_recoveries(products, aliases, resolutions, recoveries, results)[1]


@query("captures", "capture_changes", sql="""
SELECT c.slug, c.crawl_id, coalesce(n.outcome, c.outcome) AS outcome, coalesce(n.attempt, c.attempts) AS attempts, n.http_status, n.error AS last_error
FROM captures c LEFT JOIN capture_changes n ON c.slug = n.slug AND c.crawl_id = n.crawl_id""")  # fmt: skip
def capture_outcomes(captures, changes):
    return R.capture_outcomes(captures, changes).select("slug", "crawl_id", "outcome", "attempts", "http_status", "last_error")


@query("candidates", "source_ids", "resolutions", sql=r"""
SELECT a.slug FROM candidates a LEFT JOIN (SELECT DISTINCT slug FROM source_ids) s ON s.slug = a.slug LEFT JOIN resolutions r ON r.post_slug = a.slug
WHERE a.path_kind = 'posts' AND (s.slug IS NULL OR regexp_matches(a.slug, '^[0-9]+$')) AND r.post_slug IS NULL AND regexp_matches(a.slug, '^[a-z0-9][a-z0-9_-]*$') ORDER BY a.slug LIMIT 60""")  # fmt: skip
def pending_posts(candidates, source_ids, resolutions):
    return R.pending_posts(candidates, source_ids, resolutions, 60)


@query("candidates", "source_ids", "resolutions", sql=r"""
SELECT post_slug, outcome FROM resolutions UNION ALL
SELECT DISTINCT a.slug, 'unavailable' FROM candidates a WHERE path_kind = 'posts' AND a.slug NOT IN (SELECT slug FROM source_ids) AND a.slug NOT IN (SELECT post_slug FROM resolutions) AND NOT regexp_matches(a.slug, '^[a-z0-9][a-z0-9_-]*$')""")  # fmt: skip
def bad_posts(candidates, source_ids, resolutions):
    return R.bad_posts(candidates, source_ids, resolutions).select("post_slug", "outcome")


@query("products", "candidates", sql="""
SELECT slug FROM products WHERE status IN ('pending', 'retry') AND slug IN (SELECT slug FROM candidates WHERE path_kind = 'products') ORDER BY slug LIMIT 30""")  # fmt: skip
def pending_archive_products(products, candidates):
    return R.pending_archive_products(products, candidates, 30)


@query("source_ids", "products", sql="""
SELECT product_id FROM source_ids JOIN products USING (slug) WHERE status <> 'fetched' AND product_id > 100 ORDER BY product_id LIMIT 70""")  # fmt: skip
def pending_ids(source_ids, products):
    return R.pending_ids(source_ids, products, 100, 70)


@query("captures", "candidates", sql="""
SELECT slug, event_type AS crawl_id, EXISTS (SELECT 1 FROM captures c WHERE c.slug = w.slug AND c.crawl_id = w.event_type) AS complete
FROM (SELECT DISTINCT slug, e.event_type FROM candidates, (SELECT DISTINCT crawl_id AS event_type FROM captures) e) w""")  # fmt: skip
def scan_complete(captures, candidates):
    wanted = candidates.select("slug").distinct().crossJoin(F.broadcast(captures.select("crawl_id").distinct()))  # a handful of crawls
    return R.scan_complete(captures, wanted, ["slug", "crawl_id"])


_INDEX = "index_id string, path_kind string, captures long, unique_candidates long, malformed_lines long"


def _found(candidates: DataFrame) -> DataFrame:
    return candidates.where("slug like 'p1%'").select("path_kind", "slug").unionByName(candidates.where("path_kind = 'products'").select("path_kind", F.concat("slug", F.lit("0")).alias("slug")))


@query("candidates", "products", "aliases", sql="""
, f AS (SELECT path_kind, slug FROM candidates WHERE slug LIKE 'p1%' UNION SELECT path_kind, concat(slug, '0') FROM candidates WHERE path_kind = 'products')
SELECT coalesce(c.path_kind, f.path_kind) AS path_kind, coalesce(c.slug, f.slug) AS slug, CAST(coalesce(first_seen_at, 9) AS BIGINT) AS first_seen_at, CAST(CASE WHEN f.slug IS NULL THEN 1 ELSE 9 END AS BIGINT) AS last_seen_at
FROM candidates c FULL JOIN f ON c.path_kind = f.path_kind AND c.slug = f.slug""")  # fmt: skip
def archive_candidates(candidates, products, aliases):
    spark = candidates.sparkSession
    scan = spark.createDataFrame([("i1", "products", 7, 0), ("i1", "posts", 8, 1)], "index_id string, path_kind string, captures long, malformed_lines long")
    return R.archive_scan(candidates, products, aliases, spark.createDataFrame([], _INDEX), _found(candidates), scan, F.lit(9).cast("long"))[0]


@query("candidates", "products", "aliases", sql="""
, f AS (SELECT path_kind, slug FROM candidates WHERE slug LIKE 'p1%' UNION SELECT path_kind, concat(slug, '0') FROM candidates WHERE path_kind = 'products')
SELECT slug, status FROM products UNION ALL SELECT slug, 'pending' FROM f WHERE path_kind = 'products' AND slug NOT IN (SELECT slug FROM products) AND slug NOT IN (SELECT alias_slug FROM aliases)""")  # fmt: skip
def archive_products(candidates, products, aliases):
    spark = candidates.sparkSession
    scan = spark.createDataFrame([("i1", "products", 7, 0)], "index_id string, path_kind string, captures long, malformed_lines long")
    return R.archive_scan(candidates, products, aliases, spark.createDataFrame([], _INDEX), _found(candidates), scan, F.lit(9).cast("long"))[1].select("slug", "status")


@query("products", "aliases", "source_ids", "lookups", sql="""
, f AS (SELECT slug, last(product_id ORDER BY ordinal) AS product_id, max(name) AS any_name, last(name ORDER BY ordinal) AS name FROM lookups GROUP BY slug)
SELECT coalesce(p.slug, f.slug) AS slug, CASE WHEN f.slug IS NULL THEN status WHEN f.product_id IS NULL THEN 'unavailable' ELSE 'fetched' END AS status,
  CASE WHEN f.slug IS NULL THEN http_status WHEN f.product_id IS NULL THEN 404 ELSE 200 END AS http_status, coalesce(f.name, p.name) AS name
FROM products p FULL JOIN f ON p.slug = f.slug WHERE p.slug IS NOT NULL OR f.product_id IS NOT NULL""")  # fmt: skip
def lookup_products(products, aliases, source_ids, lookups):
    return R.product_resolutions(products, aliases, source_ids, lookups)[0].select("slug", "status", "http_status", "name")


@query("products", "aliases", "source_ids", "lookups", sql="""
SELECT product_id, slug FROM source_ids UNION SELECT product_id, slug FROM lookups WHERE product_id IS NOT NULL""")  # fmt: skip
def lookup_ids(products, aliases, source_ids, lookups):
    return R.product_resolutions(products, aliases, source_ids, lookups)[2]


def _parts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("categories", F.when(F.length("slug") % 2 == 0, F.array(F.lit("a"), F.col("slug"))).otherwise(F.array().cast("array<string>")))


@query("products", "records", sql="""
SELECT p.slug, coalesce(r.name, p.name) AS name, p.tagline, coalesce(r.description, p.description) AS description, coalesce(r.website_url, p.website_url) AS website_url,
  CASE WHEN r.slug IS NOT NULL AND length(p.slug) % 2 = 0 THEN 'a|' || p.slug ELSE 'old' END AS categories, CASE WHEN r.slug IS NULL THEN status ELSE 'fetched' END AS status, CASE WHEN r.slug IS NULL THEN p.content_hash ELSE r.content_hash END AS content_hash
FROM products p LEFT JOIN (SELECT * FROM records WHERE description IS NOT NULL AND website_url IS NOT NULL) r ON p.slug = r.slug""")  # fmt: skip
def catalogue_completed(products, records):
    now = products.withColumn("categories", F.array(F.lit("old")))
    rows, _ = R.completed(now, _parts(records))
    return rows.select("slug", "name", "tagline", "description", "website_url", F.array_join("categories", "|").alias("categories"), "status", "content_hash")


@query("products", "records", sql="""
SELECT count(*) AS newly_fetched FROM products JOIN records USING (slug) WHERE records.description IS NOT NULL AND records.website_url IS NOT NULL AND status <> 'fetched'""")  # fmt: skip
def catalogue_newly_fetched(products, records):
    return R.completed(products.withColumn("categories", F.array(F.lit("old"))), _parts(records))[1]


@query("products", "external", sql="""
, e AS (SELECT * FROM external WHERE tagline IS NOT NULL AND website_url IS NOT NULL),
h AS (SELECT p.*, e.slug IS NOT NULL AND (status = 'unavailable' OR (status = 'fetched' AND p.description = '')) AS hit, e.name AS n, e.tagline AS t, e.description AS d, e.website_url AS w FROM products p LEFT JOIN e ON p.slug = e.slug)
SELECT slug, CASE WHEN hit THEN n ELSE name END AS name, CASE WHEN hit THEN t ELSE tagline END AS tagline, CASE WHEN hit THEN coalesce(d, t) ELSE description END AS description, CASE WHEN hit THEN w ELSE website_url END AS website_url,
  CASE WHEN hit THEN 'fetched' ELSE status END AS status, CASE WHEN NOT hit THEN http_status END AS http_status, CASE WHEN NOT hit THEN next_retry_at END AS next_retry_at, CASE WHEN NOT hit THEN last_error END AS last_error,
  CASE WHEN hit THEN sha256(concat_ws(chr(31), slug, n, t, d, w, CASE WHEN length(slug) % 2 = 0 THEN 'a' || chr(30) || slug ELSE '' END)) ELSE content_hash END AS content_hash FROM h""")  # fmt: skip
def external_promoted(products, external):
    rows = R.promote(products.withColumn("categories", F.array().cast("array<string>")), _parts(external))
    return rows.select("slug", "name", "tagline", "description", "website_url", "status", "http_status", "next_retry_at", "last_error", "content_hash")


_GAP = "status = 'fetched' AND (coalesce(trim(tagline), '') = '' OR coalesce(trim(description), '') = '')"


@query("products", "aliases", sql=f"""
, m AS (SELECT slug FROM products WHERE {_GAP})
SELECT 'kept' AS part, slug FROM products WHERE slug NOT IN (SELECT slug FROM m) UNION ALL SELECT 'moved', slug FROM m
UNION ALL SELECT CASE WHEN canonical_slug IN (SELECT slug FROM m) THEN 'moved alias' ELSE 'kept alias' END, alias_slug FROM aliases""")  # fmt: skip
def excluded_incomplete(products, aliases):
    parts = R.exclude_incomplete(products, aliases, "missing copy")
    out = None
    for part, rows, key in zip(("kept", "kept alias", "moved", "moved alias"), parts, ("slug", "alias_slug", "slug", "alias_slug"), strict=True):
        one = rows.select(F.lit(part).alias("part"), F.col(key).alias("slug"))
        out = one if out is None else out.unionByName(one)
    return out


@query("products", "enrichments", sql=f"""
SELECT p.slug, website_url, coalesce(e.attempts, 0) + 1 AS attempt, coalesce(trim(tagline), '') = '' AS needs_tagline, coalesce(trim(description), '') = '' AS needs_description
FROM products p LEFT JOIN enrichments e ON p.slug = e.slug
WHERE {_GAP} AND website_url NOT LIKE '%catalogue.example/%' AND regexp_matches(website_url, '^https?://[^ ]+$', 'i') AND (e.slug IS NULL OR (e.outcome = 'retry' AND e.attempts < 2)) ORDER BY p.slug LIMIT 45""")  # fmt: skip
def website_claims(products, enrichments):
    return R.claim_websites(products, enrichments, "catalogue.example", 2, 45)


@query("recoveries", sql="""
SELECT slug, CASE WHEN outcome = 'not_found' THEN 'retry' ELSE outcome END AS outcome FROM recoveries""")  # fmt: skip
def recovery_requeued(recoveries):
    return R.requeue(recoveries, ["not_found"], ("not_found", "parse_failed", "fetch_failed"))[0].select("slug", "outcome")


@query("products", "aliases", "recoveries", "candidates", "resolutions", "captures", "source_ids", sql="""
SELECT 'products' AS section, status AS name, count(*) AS n FROM products GROUP BY status
UNION ALL SELECT 'products', 'total', count(*) FROM products UNION ALL SELECT 'products', 'ready_retry', count(*) FROM products WHERE status = 'retry' AND next_retry_at IS NULL
UNION ALL SELECT 'aliases', 'rows', count(*) FROM aliases UNION ALL SELECT 'recoveries', outcome, count(*) FROM recoveries GROUP BY outcome
UNION ALL SELECT 'candidates', path_kind, count(*) FROM candidates GROUP BY path_kind UNION ALL SELECT 'resolutions', outcome, count(*) FROM resolutions GROUP BY outcome
UNION ALL SELECT 'captures', outcome, count(*) FROM captures GROUP BY outcome UNION ALL SELECT 'source_ids', 'rows', count(*) FROM source_ids""")  # fmt: skip
def status_report(products, aliases, recoveries, candidates, resolutions, captures, source_ids):
    tables = {"products": products, "aliases": aliases, "recoveries": recoveries, "candidates": candidates, "resolutions": resolutions, "captures": captures, "source_ids": source_ids}
    return R.status_report(products.sparkSession, tables)
