"""The catalogue's transactions over the driver's tables, with SQL for each.

Customers are the current products; orders and events are batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import catalogue as C
from tessera.sources.binding import read


def _products(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").where("c_custkey % 3 > 0").select(
        F.col("c_custkey").cast("string").alias("slug"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 4 > 0, F.col("c_mktsegment")).alias("tagline"),
        F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("description"), F.lit(None).cast("string").alias("website_url"),
        F.when(F.col("c_acctbal") >= 0, "fetched").otherwise("pending").alias("status"), F.col("c_custkey").alias("source_lastmod"), F.lit(0).alias("attempts"),
        F.lit(None).cast("array<string>").alias("categories"), F.lit("api").alias("tagline_source"), F.lit("api").alias("description_source"), F.lit("h").alias("content_hash"),
    )


def _aliases(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").where("c_custkey % 7 = 0 AND c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("alias_slug"), F.lit("1").alias("canonical_slug"))


def catalogue_import(spark: SparkSession, d: str) -> DataFrame:
    batch = read(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("slug"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).alias("lastmod"))
    excluded = read(spark, d, "customer").where("c_custkey % 11 = 0 AND c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("slug"))
    rows, _ = C.import_products(_products(spark, d), _aliases(spark, d), excluded, batch)
    return rows.select("slug", "status", "source_lastmod", F.col("attempts").cast("long").alias("attempts"))


def catalogue_id_scan(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    records = o.select(
        F.col("o_orderkey").alias("product_id"), F.col("o_custkey").cast("string").alias("slug"), F.lit(None).cast("string").alias("name"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("tagline"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("description"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey").cast("string")).alias("website_url"), F.col("o_orderkey").alias("ordinal"),
    )
    ids = o.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("product_id"), F.lit("x").alias("slug"), F.lit(1).cast("long").alias("first_seen_at"), F.lit(1).cast("long").alias("last_seen_at"))
    rows, _ = C.apply_catalogue_batch(_products(spark, d), ids, _aliases(spark, d), records, F.lit(9).cast("long"))
    return rows.select("slug", "name", "tagline", "description", "website_url", "status")


def catalogue_memberships(spark: SparkSession, d: str) -> DataFrame:
    items = read(spark, d, "lineitem").select(F.col("l_returnflag").alias("category_slug"), F.col("l_partkey").alias("product_id"), F.col("l_partkey").cast("string").alias("slug"), "l_linestatus")
    known = read(spark, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("product_id"))
    keys = ["category_slug", "product_id"]
    empty = spark.createDataFrame([], "category_slug string, product_id long, slug string, new_product_id boolean, first_seen_at long, last_seen_at long")
    first, _ = C.memberships(empty, items.where("l_linestatus = 'F'").drop("l_linestatus"), known, keys, F.lit(1).cast("long"))
    both, _ = C.memberships(first, items.where("l_linestatus = 'O'").drop("l_linestatus"), known, keys, F.lit(2).cast("long"))
    return both.select("category_slug", "product_id", "slug", "new_product_id", "first_seen_at", "last_seen_at")


def catalogue_resolutions(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "resolved").when(F.col("o_orderstatus") == "O", "unavailable").otherwise("no_product")
    row = lambda out: [F.col("o_orderkey").cast("string").alias("post_slug"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")).alias("post_id"), F.col("o_custkey").alias("product_id"), out.alias("product_slug"), kind.alias("outcome")]
    now = o.where("o_orderkey % 2 = 0").select(*row(F.lit("old"))).withColumn("outcome", F.when(F.col("post_id").isNull(), "unavailable").otherwise(F.col("outcome")))
    return C.resolutions(now, o.where("o_orderkey % 5 > 0").select(*row(F.lit("new"))), True)


def catalogue_enrichment(spark: SparkSession, d: str) -> DataFrame:
    found = read(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("slug"), F.substring("text", 1, 20).alias("tagline"), F.lit("h1").alias("tagline_origin"), F.when(F.col("lang") == "en", F.col("source")).alias("description"), F.col("lang").alias("description_origin")
    )
    return C.enriched(_products(spark, d), found).select("slug", "tagline", "tagline_source", "description", "description_source", "content_hash")


def catalogue_results(spark: SparkSession, d: str) -> DataFrame:
    """Fetch results of every other customer; every tenth ended at another slug."""
    c = read(spark, d, "customer").where("c_custkey % 2 = 0")
    k = F.col("c_custkey")
    results = c.select(
        k.cast("string").alias("slug"), F.when(k % 10 == 0, F.concat(F.lit("n"), (k / 10).cast("long").cast("string"))).otherwise(k.cast("string")).alias("final_slug"),
        F.when(k % 4 == 0, "fetched").otherwise("unavailable").alias("outcome"), F.when(k % 4 == 0, 200).otherwise(404).alias("http_status"), F.when(k % 4 > 0, F.lit("gone")).alias("error"),
        F.lit(None).cast("string").alias("name"), F.col("c_mktsegment").alias("tagline"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("website_url"), k.alias("ordinal"),
    )
    now = _products(spark, d).withColumn("http_status", F.lit(None).cast("int"))
    rows, aliases, errors = C.apply_results(now, _aliases(spark, d), results)
    counts = [("products", rows), ("aliases", aliases), ("errors", errors), ("unavailable", rows.where("status = 'unavailable'")), ("taglines", rows.where("tagline is not null"))]
    out = None
    for name, some in counts:
        one = some.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("what"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def catalogue_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.counts_by(read(spark, d, "events"), "event_type").unionByName(C.duplicate_keys(read(spark, d, "documents"), "text", "doc_id").withColumnRenamed("key", "state"))


QUERIES = {f.__name__: f for f in (catalogue_import, catalogue_id_scan, catalogue_memberships, catalogue_resolutions, catalogue_enrichment, catalogue_results, catalogue_counts)}

_NOW = """p AS (
  SELECT CAST(c_custkey AS VARCHAR) AS slug, c_name AS name, CASE WHEN c_custkey % 4 > 0 THEN c_mktsegment END AS tagline, CASE WHEN c_custkey % 5 > 0 THEN c_name END AS description,
    CASE WHEN c_acctbal >= 0 THEN 'fetched' ELSE 'pending' END AS status, c_custkey AS source_lastmod FROM customer WHERE c_custkey % 3 > 0)"""
SQL = {
    "catalogue_import": f"""
WITH {_NOW},
b AS (
  SELECT CAST(o_custkey AS VARCHAR) AS slug, max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END) AS lastmod FROM orders
  WHERE NOT (o_custkey % 3 = 0 AND (o_custkey % 7 = 0 OR o_custkey % 11 = 0)) GROUP BY o_custkey)
SELECT coalesce(p.slug, b.slug) AS slug, coalesce(status, 'pending') AS status, greatest(source_lastmod, lastmod) AS source_lastmod, CAST(0 AS BIGINT) AS attempts
FROM p FULL JOIN b ON p.slug = b.slug""",
    "catalogue_id_scan": f"""
WITH {_NOW},
b AS (
  SELECT CAST(o_custkey AS VARCHAR) AS slug, last(o_orderpriority ORDER BY o_orderkey) FILTER (o_orderstatus = 'F') AS t, last(o_orderpriority ORDER BY o_orderkey) FILTER (o_orderstatus = 'O') AS d,
    max(o_orderkey) FILTER (o_orderstatus = 'P') AS w FROM orders WHERE NOT (o_custkey % 3 = 0 AND o_custkey % 7 = 0) GROUP BY o_custkey),
m AS (
  SELECT coalesce(p.slug, b.slug) AS slug, name, coalesce(t, tagline) AS tagline, coalesce(d, description) AS description, CAST(w AS VARCHAR) AS website_url, status, b.slug IS NOT NULL AS seen
  FROM p FULL JOIN b ON p.slug = b.slug)
SELECT slug, name, tagline, description, website_url,
  CASE WHEN status = 'fetched' OR (seen AND name IS NOT NULL AND description IS NOT NULL AND (tagline IS NOT NULL OR website_url IS NOT NULL)) THEN 'fetched' ELSE 'pending' END AS status
FROM m""",
    "catalogue_memberships": """
SELECT l_returnflag AS category_slug, l_partkey AS product_id, CAST(l_partkey AS VARCHAR) AS slug, any_value(p_size) >= 25 AS new_product_id,
  CAST(min(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END) AS BIGINT) AS first_seen_at, CAST(max(CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END) AS BIGINT) AS last_seen_at
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag, l_partkey""",
    "catalogue_resolutions": """
WITH o AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS post_id, o_custkey, CASE o_orderstatus WHEN 'F' THEN 'resolved' WHEN 'O' THEN 'unavailable' ELSE 'no_product' END AS outcome,
    o_orderkey % 2 = 0 AS a, o_orderkey % 5 > 0 AS b FROM orders),
s AS (SELECT *, CASE WHEN post_id IS NULL THEN 'unavailable' ELSE outcome END AS before FROM o WHERE a OR b)
SELECT CAST(k AS VARCHAR) AS post_slug, post_id, o_custkey AS product_id, CASE WHEN NOT a OR (b AND outcome = 'resolved' AND before <> 'resolved') THEN 'new' ELSE 'old' END AS product_slug,
  CASE WHEN NOT a OR (b AND outcome = 'resolved' AND before <> 'resolved') THEN outcome ELSE before END AS outcome
FROM s""",
    "catalogue_enrichment": f"""
WITH {_NOW},
d AS (SELECT CAST(doc_id AS VARCHAR) AS slug, substr(text, 1, 20) AS t, CASE WHEN lang = 'en' THEN source END AS x, lang FROM documents),
m AS (SELECT p.*, t, x, lang, coalesce(trim(tagline), '') = '' AND coalesce(trim(t), '') <> '' AS ft, coalesce(trim(description), '') = '' AND coalesce(trim(x), '') <> '' AS fd FROM p LEFT JOIN d ON p.slug = d.slug),
n AS (SELECT slug, name, ft, fd, lang, CASE WHEN ft THEN t ELSE tagline END AS tagline, CASE WHEN fd THEN x ELSE description END AS description FROM m)
SELECT slug, tagline, CASE WHEN ft THEN 'website:h1' ELSE 'api' END AS tagline_source, description, CASE WHEN fd THEN 'website:' || lang ELSE 'api' END AS description_source,
  CASE WHEN ft OR fd THEN sha256(concat_ws(chr(31), slug, name, tagline, description, '')) ELSE 'h' END AS content_hash
FROM n""",
    "catalogue_results": f"""
WITH {_NOW},
r AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey % 20 = 0 THEN 'n' || (c_custkey // 10) ELSE CAST(c_custkey AS VARCHAR) END AS slug, c_custkey % 4 = 0 AS ok, c_custkey % 20 = 0 AS moved, c_mktsegment FROM customer WHERE c_custkey % 2 = 0),
kept AS (SELECT * FROM p WHERE slug NOT IN (SELECT CAST(k AS VARCHAR) FROM r WHERE moved)),
m AS (SELECT coalesce(kept.slug, r.slug) AS slug, coalesce(c_mktsegment, tagline) AS tagline, r.slug IS NOT NULL AND NOT ok AS gone FROM kept FULL JOIN r ON kept.slug = r.slug)
SELECT 'products' AS what, count(*) AS n FROM m
UNION ALL SELECT 'aliases', count(*) FROM (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 21 = 0 UNION SELECT CAST(k AS VARCHAR) FROM r WHERE moved)
UNION ALL SELECT 'errors', count(*) FROM r WHERE NOT ok
UNION ALL SELECT 'unavailable', count(*) FROM m WHERE gone
UNION ALL SELECT 'taglines', count(*) FROM m WHERE tagline IS NOT NULL""",
    "catalogue_counts": """
SELECT event_type AS state, count(*) AS n FROM events GROUP BY event_type
UNION ALL SELECT 'text', count(*) FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)
UNION ALL SELECT 'doc_id', count(*) FROM (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) > 1)""",
}
