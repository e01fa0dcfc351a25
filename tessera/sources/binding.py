"""The catalogue's relations, bound to the driver's tables.

Customers stand for products, orders for ids, launches and labels, line items for entities, documents for copy,
pages for web sites and parts for categories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The catalogue's own host: a web site there is not an external one.
OWN_HOST = "catalogue.example"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slug(key: Column) -> Column:
    return F.concat(F.lit("p"), key.cast("string"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("k"), "text", "lang", "source")
    site = read(spark, sf_dir, "pages").select(F.col("page_id").alias("k"), "url")
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name")
    base = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name", "c_acctbal")
    return base.join(copy, "k", "left").join(site, "k", "left").join(part, "k", "left").select(
        slug(F.col("k")).alias("slug"),
        F.col("c_name").alias("name"),
        F.substring("text", 1, 60).alias("tagline"),
        F.col("text").alias("description"),
        F.col("url").alias("website_url"),
        F.concat(F.lit(f"https://{OWN_HOST}/products/"), slug(F.col("k"))).alias("product_url"),
        F.split("p_name", " ").alias("categories"),
        F.when(F.col("c_acctbal") >= 0, "fetched").otherwise("unavailable").alias("status"),
        F.pmod("k", F.lit(5)).cast("long").alias("attempts"),
        F.col("lang").alias("tagline_source"),
        F.col("source").alias("description_source"),
    )


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(slug(F.col("o_custkey")).alias("slug"), F.col("o_orderkey").alias("product_id"))


def launches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        slug(F.col("o_custkey")).alias("slug"),
        F.concat(F.lit("l"), F.col("o_orderkey").cast("string")).alias("post_slug"),
        F.col("o_orderkey").alias("post_id"),
        F.col("o_orderkey").alias("product_id"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        slug(F.col("o_custkey")).alias("slug"),
        F.col("o_orderpriority").alias("tag"),
        F.col("o_totalprice").alias("score"),
        F.pmod("o_orderkey", F.lit(3)).alias("rank"),
        F.lit("v1").alias("taxonomy_version"),
        F.col("o_orderkey").cast("string").alias("method"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        slug(F.col("o_custkey")).alias("slug"),
        F.col("l_returnflag").alias("entity_type"),
        F.col("p_brand").alias("canonical_value"),
        F.col("p_name").alias("source_span"),
        F.col("l_extendedprice").alias("score"),
        F.col("p_size").cast("long").alias("support_products"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("method"),
    )


def relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {f.__name__: f(spark, sf_dir) for f in (products, ids, launches, labels, entities)}
