"""The dashboard's panels, reports and the check over the driver's tables, with SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import final_slug
from tessera.plans import dashboard, outcome_queries, recovery_queries, reports
from tessera.plans.mart import Mart
from tessera.plans.oracle import over_mart
from tessera.sources.binding import read, relations
from tessera.sources.imports import unescaped


def dashboard_metrics(spark: SparkSession, d: str) -> DataFrame:
    return dashboard.metrics(Mart(relations(spark, d)))


def _panel(name: str):  # noqa: ANN202
    return lambda spark, d: dashboard.panel(Mart(relations(spark, d)), name)


def _products(spark: SparkSession, d: str) -> DataFrame:
    """Orders as products: slugs and addresses that some share, and every status."""
    return read(spark, d, "orders").selectExpr(*(f"{x} AS {c}" for c, x in _PRODUCTS.items()))


_PRODUCTS = {
    "slug": "CASE WHEN o_orderkey % 40 = 0 THEN concat('c', CAST(o_custkey AS STRING)) WHEN o_orderkey % 41 > 0 THEN concat('o', CAST(o_orderkey AS STRING)) END", "product_url": "concat('https://catalogue.example/', CAST(o_orderkey - o_orderkey % 2 AS STRING))",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'O' THEN 'parse_failed' ELSE 'retry' END", "next_retry_at": "CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END", "name": "CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority WHEN o_orderkey % 10 > 0 THEN '' END",
    "description": "CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority ELSE '' END", "tagline": "CASE WHEN o_orderkey % 2 > 0 THEN '' END", "website_url": "CASE WHEN o_orderkey % 4 > 0 THEN 'https://w.example' END",
}


def catalogue_verify(spark: SparkSession, d: str) -> DataFrame:
    return reports.verify(_products(spark, d))


def catalogue_status(spark: SparkSession, d: str) -> DataFrame:
    b, o = (lambda n: recovery_queries.bound(spark, d, n)), (lambda n: outcome_queries.bound(spark, d, n))
    c = read(spark, d, "customer")
    scans = c.select(F.col("c_custkey").alias("captures"), (F.col("c_custkey") % 2).alias("malformed_lines"))
    staged = b("external").withColumns({"source": F.when(F.length("slug") % 2 == 0, "a").otherwise("b"), "product_id": F.when(F.col("tagline").isNotNull(), F.lit(1))})
    sites = c.select((F.col("c_custkey") % 3).cast("string").alias("outcome"), (F.col("c_custkey") % 2 == 0).alias("applied_tagline"), (F.col("c_custkey") % 5 == 0).alias("applied_description"))
    out = c.where("c_custkey % 4 = 0").select(F.col("c_mktsegment").alias("exclusion_reason"))
    resolved = b("resolutions").withColumns({"post_id": F.when(F.length("post_slug") > 4, F.lit(1)), "product_slug": F.substring("post_slug", 1, 3)})
    return reports.status(
        reports.products(_products(spark, d)), reports.recoveries(o("recoveries")), reports.captures(b("captures")), reports.archived(b("candidates"), scans), reports.resolutions(resolved), reports.external(staged), reports.websites(sites), reports.excluded(out)
    )


def final_slugs(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of one, two and more segments; all but those of two keep the slug that was asked for."""
    k = F.col("o_orderkey").cast("string")
    tail = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("/products/X"), k)).when(F.col("o_orderkey") % 5 == 1, F.concat(F.lit("/products/X"), k, F.lit("/reviews"))).when(F.col("o_orderkey") % 5 == 2, F.concat(F.lit("//products/"), k, F.lit("/?a=/b"))).when(F.col("o_orderkey") % 5 == 3, "/products").otherwise(F.concat(F.lit("/posts/"), k))
    return read(spark, d, "orders").select("o_orderkey", final_slug(F.concat(F.lit("https://catalogue.example"), tail), F.concat(F.lit("asked"), k)).alias("slug"))


def unescaped_texts(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit(" &lt;b&gt; &quot;"), F.coalesce("text", F.lit("")), F.lit("&quot; &amp;amp; x<br>y<br />&eacute;&#8364;&hellip; "))
    return read(spark, d, "documents").where("text IS NULL OR NOT contains(text, '&')").select("doc_id", F.md5(unescaped(text)).alias("digest"))


QUERIES = {"dashboard_metrics": dashboard_metrics, **{f"panel_{n}": _panel(n) for n in dashboard.PANELS}, **{f.__name__: f for f in (catalogue_verify, catalogue_status, final_slugs, unescaped_texts)}}

_ORDERS = "p AS (SELECT " + ", ".join(f"{x} AS {c}" for c, x in _PRODUCTS.items()) + " FROM orders)"


def _parts(section: str, table: str, state: str | None, **numbers: str) -> str:
    parts = [f"SELECT '{section}' AS section, CAST({state} AS VARCHAR) AS name, count(*) AS n FROM {table} GROUP BY 2"] if state else []
    return " UNION ALL ".join(parts + [f"SELECT '{section}', '{n}', CAST(coalesce({x}, 0) AS BIGINT) FROM {table}" for n, x in numbers.items()])


SQL = {
    "dashboard_metrics": over_mart(
        """SELECT count(*) AS products, count_if(has_external_website) AS external_websites, count_if(has_source_categories) AS categorized_products, CAST(sum(source_category_count) AS BIGINT) AS category_assignments, count_if(has_trusted_label) AS labeled_products,
  CAST(sum(trusted_label_count) AS BIGINT) AS label_assignments, count_if(has_entity) AS entity_products, CAST(sum(entity_count) AS BIGINT) AS entity_assignments, count_if(has_launch_mapping) AS launched_products, CAST(sum(launch_count) AS BIGINT) AS launch_relationships,
  count_if(launch_count > 1) AS relaunched_products, (SELECT count(*) FROM domain_stats) AS distinct_domains FROM product_facts"""
    ),
    **{f"panel_{n}": over_mart(f"SELECT {', '.join(columns)} FROM ({dashboard.list_sql(f'dashboard_{n}')})") for n, columns in dashboard.PANELS.items()},
    "catalogue_verify": f"""
WITH {_ORDERS},
c AS (SELECT count(*) AS products, count_if(status = 'fetched') AS fetched, count_if(status = 'parse_failed') AS parse_failed, count_if(status = 'fetched' AND coalesce(name, '') <> '' AND coalesce(description, '') <> '' AND (tagline IS NOT NULL OR website_url IS NOT NULL)) AS complete_fetched,
  (SELECT count(*) FROM (SELECT slug FROM p WHERE slug IS NOT NULL GROUP BY slug HAVING count(*) > 1)) AS duplicate_slugs, (SELECT count(*) FROM (SELECT product_url FROM p GROUP BY product_url HAVING count(*) > 1)) AS duplicate_product_urls FROM p)
SELECT *, complete_fetched / fetched AS fetched_completeness, fetched / (fetched + parse_failed) AS reachable_parse_success, duplicate_slugs = 0 AND duplicate_product_urls = 0 AS passed FROM c""",
    "catalogue_status": f"""
{recovery_queries._with('captures', 'candidates', 'resolutions', 'external')}, {outcome_queries._with('recoveries')[5:]}, {_ORDERS}
SELECT * FROM ({' UNION ALL '.join((
    _parts('products', 'p', 'status', total='count(*)', ready_retry="count_if(status = 'retry' AND next_retry_at IS NULL)"),
    _parts('recoveries', 'recoveries', 'outcome', total='count(*)', attempts='sum(attempts)'),
    _parts('captures', 'captures', 'outcome', captures='count(*)', products='count(DISTINCT slug)', crawls='count(DISTINCT crawl_id)'),
    _parts('archived', 'candidates', 'path_kind'),
    _parts('archived', 'customer', None, scans='count(*)', captures='sum(c_custkey)', malformed_lines='sum(c_custkey % 2)'),
    _parts('resolutions', 'resolutions', 'outcome', with_post_id='count_if(length(post_slug) > 4)', products='count(DISTINCT substr(post_slug, 1, 3))'),
    _parts('external', 'external', "CASE WHEN length(slug) % 2 = 0 THEN 'a' ELSE 'b' END", total='count(*)', complete='count_if(tagline IS NOT NULL AND website_url IS NOT NULL)', with_product_id='count_if(tagline IS NOT NULL)'),
    _parts('websites', 'customer', 'c_custkey % 3', applied_taglines='count_if(c_custkey % 2 = 0)', applied_descriptions='count_if(c_custkey % 5 = 0)'),
    "SELECT 'excluded', c_mktsegment, count(*) FROM customer WHERE c_custkey % 4 = 0 GROUP BY 2",
))}) WHERE n > 0""",
    "final_slugs": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'x' || o_orderkey WHEN 2 THEN CAST(o_orderkey AS VARCHAR) ELSE 'asked' || o_orderkey END AS slug FROM orders",
    "unescaped_texts": """
SELECT doc_id, md5('<b> "' || coalesce(text, '') || '" &amp; x' || chr(10) || 'y' || chr(10) || 'é€…') AS digest FROM documents WHERE text IS NULL OR NOT contains(text, '&')""",
}
