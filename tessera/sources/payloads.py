"""Captured API answers as rows: id batches, launches, searches, categories and collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NODE = "struct<id:string,slug:string,name:string,tagline:string,description:string,websiteUrl:string,meta:struct<description:string>>"


def _product(node: Column) -> list[Column]:
    """Product columns of a node; a missing description falls back to the page's own."""
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return [
        node["id"].try_cast("long").alias("product_id"), text(node["slug"]).alias("slug"), text(node["name"]).alias("name"), text(node["tagline"]).alias("tagline"),
        F.coalesce(text(node["description"]), text(node["meta"]["description"])).alias("description"), text(node["websiteUrl"]).alias("website_url"),
    ]


def id_batches(spark: SparkSession, payloads: DataFrame, start: int, stop: int) -> DataFrame:
    """One row per id of a range: its product, or `unavailable` where the answers have none under p<id>."""
    nodes = payloads.select(F.explode(F.from_json(F.get_json_object("value", "$.data"), f"map<string,{_NODE}>")).alias("alias", "node"))
    rows = nodes.where("node is not null").select(F.regexp_extract("alias", "^p([0-9]+)$", 1).try_cast("long").alias("asked"), *_product(F.col("node")))
    rows = rows.where("asked = product_id and slug is not null").dropDuplicates(["asked"])
    return spark.range(start, stop).withColumnRenamed("id", "asked").join(rows, "asked", "left").withColumn("outcome", F.when(F.col("slug").isNull(), "unavailable").otherwise("found"))


def launch_outcome(post: Column) -> Column:
    """resolved, no_product or unavailable for a launch (id, product struct) that was asked for."""
    return F.when(post.isNull(), "unavailable").when(post["product"]["slug"].isNull(), "no_product").otherwise("resolved")


def launches(payloads: DataFrame) -> DataFrame:
    """Launch resolutions of answers that hold one object for each asked slug; `exact` tells for numeric questions whether the id is the one asked for."""
    kind = "map<string,struct<id:string,slug:string,product:struct<id:string,slug:string>>>"
    rows = payloads.select("asked", F.from_json(F.get_json_object("value", "$.data"), kind).alias("m"))
    each = rows.select(F.posexplode("asked").alias("i", "post_slug"), "m").select("post_slug", F.try_element_at("m", F.concat(F.lit("p"), F.col("i").cast("string"))).alias("post"))
    digits = F.col("post_slug").rlike("^[0-9]+$")
    exact = F.when(~digits | (F.col("post.id") == F.col("post_slug")), F.col("post"))
    return each.withColumn("post", exact).select(
        "post_slug", F.col("post.id").try_cast("long").alias("post_id"), F.col("post.product.id").try_cast("long").alias("product_id"),
        F.lower("post.product.slug").alias("product_slug"), launch_outcome(F.col("post")).alias("outcome"),
    )


def search_pages(payloads: DataFrame) -> DataFrame:
    """Products of search answers, once per id; of several the last."""
    rows = payloads.select("page", F.posexplode(F.from_json(F.get_json_object("value", "$.data.search.edges"), f"array<struct<node:{_NODE}>>")).alias("i", "edge"))
    rows = rows.select("page", "i", *_product(F.col("edge.node"))).where("product_id is not null and slug is not null")
    return rows.groupBy("product_id").agg(F.max_by(F.struct("slug", "name", "tagline"), F.struct("page", "i")).alias("r")).select("product_id", "r.*")


def category_links(pages: DataFrame) -> DataFrame:
    """Category slugs linked in pages, once each, in order of their first link."""
    links = F.regexp_extract_all("html", F.lit(r'href="/categories/([a-z0-9-]+)[^"]*"'), F.lit(1))
    return pages.select(F.posexplode(F.array_distinct(links)).alias("position", "category_slug"))


def collections(payloads: DataFrame, inline: int = 100) -> tuple[DataFrame, DataFrame]:
    """(memberships, overflows): products listed with their collections, and collections with more than `inline`."""
    kind = f"array<struct<node:struct<id:string,productsCount:int,products:struct<edges:array<struct<node:{_NODE}>>>>>>"
    rows = payloads.select(F.explode(F.from_json(F.get_json_object("value", "$.data.collections.edges"), kind)).alias("e")).select("e.node.*")
    rows = rows.where("id is not null").select(F.col("id").try_cast("long").alias("collection_id"), F.col("productsCount").alias("products_count"), F.col("products.edges").alias("edges"))
    inside = rows.select("collection_id", F.explode("edges").alias("edge")).select("collection_id", *_product(F.col("edge.node"))).where("product_id is not null")
    over = rows.where(F.col("products_count") > inline).select("collection_id", "products_count", F.lit(inline).alias("next_offset"))
    return inside.select("collection_id", "product_id", "slug").distinct(), over
