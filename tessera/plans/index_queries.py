"""Queries over capture indexes and audit rows bound to the driver's tables, with SQL for each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import entities
from tessera.sources import indexes

_BLOCKS = """SELECT o_orderpriority AS file, concat(o_orderstatus, ')', CAST(o_custkey AS STRING)) AS key, CAST(o_orderkey AS BIGINT) * 1000 AS "offset", CAST(o_custkey AS BIGINT) AS length FROM orders"""


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat("o_orderstatus", F.lit(")"), F.col("o_custkey").cast("string"))
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("file"), key.alias("key"), (F.col("o_orderkey").cast("long") * 1000).alias("offset"), F.col("o_custkey").cast("long").alias("length"))


def index_hit_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.hit_ranges(_blocks(spark, sf_dir), "P)12", 30_000_000)


def index_key_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexes.key_range(_blocks(spark, sf_dir), "O)3", "O)5")


def audit_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("slug"), F.col("o_orderpriority").alias("entity_type"), F.col("o_orderkey").alias("canonical_value"))
    products = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 3 > 0")
    products = products.select(F.col("c_custkey").alias("slug"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("tagline"), F.col("c_name").alias("description"))
    return entities.audit_context(found, products).select("slug", "entity_type", "canonical_value", "name", entities.prompt_text(F.col("tagline"), F.col("description")).alias("prompt"))


QUERIES = {"index_hit_ranges": index_hit_ranges, "index_key_range": index_key_range, "audit_context": audit_context}
SQL = {
    "index_hit_ranges": f"""
WITH b AS ({_BLOCKS}), n AS (
  SELECT *, "offset" + length AS stop, lag("offset", 1, "offset") OVER w AS before, lead("offset" + length, 1, "offset" + length) OVER w AS after FROM b WINDOW w AS (PARTITION BY file ORDER BY "offset")),
r AS (SELECT file, min(before) FILTER (starts_with(key, 'P)12')) AS start, max_by(after, "offset") FILTER (starts_with(key, 'P)12')) AS stop FROM n GROUP BY file)
SELECT file, start, stop - start AS length, CASE WHEN start IS NULL THEN 'no key' WHEN stop - start > 30000000 THEN 'too large' END AS problem FROM r""",
    "index_key_range": f"""
WITH b AS ({_BLOCKS}), p AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY key DESC, "offset" DESC) AS n FROM b WHERE key < 'O)3')
SELECT file, key, "offset", length FROM b WHERE key >= 'O)3' AND key < 'O)5' UNION ALL SELECT file, key, "offset", length FROM p WHERE n = 1""",
    "audit_context": """
SELECT o_custkey AS slug, o_orderpriority AS entity_type, o_orderkey AS canonical_value, c_name AS name,
  CASE WHEN c_custkey % 2 = 0 THEN concat('Tagline: ', c_mktsegment, chr(10)) ELSE '' END || concat('Description: ', c_name) AS prompt
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 3 > 0""",
}
