"""Other catalogues' files as staged rows: launch exports with redirects, metadata tables, zipped daily files and
markdown reports. All give slug, the copy fields, categories, product_url and an ordinal."""

from __future__ import annotations

import html
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import product_slug, split_nonblank, stripped, without_prefix
from tessera.operators.relational import best_per_key
from tessera.sources.captures import last_per_slug, zipped_csv

LAUNCHES = "slug string, name string, tagline string, description string, website string, ph_url string, launch_date string, topic_slugs string"
METADATA = "homepage string, url string, name string, description string, title string"


def _csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)


def launches(spark: SparkSession, path: str, host: str) -> DataFrame:
    """One row per product of a launch export: one with a description before others, then the newest."""
    rows = _csv(spark, path, LAUNCHES).withColumn("product", F.coalesce(product_slug(F.col("ph_url"), host), F.lower(F.col("slug"))))
    best = best_per_key(rows.where("product is not null"), ["product"], [F.desc(stripped(F.col("description")).isNotNull()), F.desc_nulls_last("launch_date"), F.asc("slug")])
    return best.select(
        F.col("product").alias("slug"), *(stripped(F.col(c)).alias(c) for c in ("name", "tagline", "description")), stripped(F.col("website")).alias("website_url"),
        split_nonblank(F.col("topic_slugs"), r"\|").alias("categories"), F.col("ph_url").alias("product_url"),
    )


def redirects(spark: SparkSession, path: str, start: str, target: str, token: str = r"/r/([A-Za-z0-9]+)") -> DataFrame:
    """(token, direct_url): where redirect links lead; a known target before none, then the first in order."""
    rows = _csv(spark, path).select(F.lower(F.nullif(F.regexp_extract(F.col(f"`{start}`"), token, 1), F.lit(""))).alias("token"), stripped(F.col(f"`{target}`")).alias("direct_url"))
    return best_per_key(rows.where("token is not null"), ["token"], [F.desc(F.col("direct_url").isNotNull()), F.asc("direct_url")])


def with_direct_sites(rows: DataFrame, links: DataFrame, token: str = r"/r/([A-Za-z0-9]+)") -> DataFrame:
    """Web sites given as redirect links replaced by what they lead to."""
    keyed = rows.withColumn("token", F.lower(F.nullif(F.regexp_extract("website_url", token, 1), F.lit(""))))
    joined = keyed.join(links, "token", "left")
    return joined.withColumn("website_url", F.when(F.col("token").isNull(), F.col("website_url")).otherwise(F.col("direct_url"))).drop("token", "direct_url")


def filled_from(rows: DataFrame, dump: DataFrame, columns: tuple[str, ...] = ("name", "tagline", "description", "website_url")) -> DataFrame:
    """Values of a dump win where they are not empty."""
    other = dump.select("slug", *(F.col(c).alias(f"_d_{c}") for c in columns))
    return rows.join(other, "slug", "left").withColumns({c: F.coalesce(F.nullif(f"_d_{c}", F.lit("")), c) for c in columns}).drop(*(f"_d_{c}" for c in columns))


def metadata(spark: SparkSession, path: str, host: str, known: DataFrame) -> DataFrame:
    """Complete rows of a metadata table whose product isn't known; the tagline is the title without the name."""
    rows = _csv(spark, path, METADATA).select(
        product_slug(F.col("url"), host).alias("slug"), stripped(F.col("name")).alias("name"), stripped(F.col("description")).alias("description"),
        stripped(F.col("homepage")).alias("website_url"), stripped(F.col("title")).alias("title"), F.col("url").alias("product_url"),
    )
    rows = rows.withColumn("tagline", without_prefix(F.col("title"), F.col("name"))).drop("title")
    whole = rows.where("slug is not null and name is not null and description is not null and website_url is not null and tagline is not null")
    once = best_per_key(whole, ["slug"], [F.asc("product_url"), F.asc("tagline")])
    return once.join(known.select("slug"), "slug", "left_anti").withColumn("categories", F.array().cast("array<string>"))


def daily(spark: SparkSession, path: str, host: str) -> DataFrame:
    """Rows of daily CSV files in ZIPs; the later file and row of a product wins."""
    field = lambda name: stripped(F.col("fields")[name])
    rows = zipped_csv(spark, path)
    last = last_per_slug(rows, product_slug(F.col("fields")["URL"], host))
    return last.select(
        "slug", field("Name").alias("name"), field("Tagline").alias("tagline"), F.coalesce(field("Description"), field("Tagline")).alias("description"),
        field("Website").alias("website_url"), split_nonblank(F.col("fields")["Topics"], ",").alias("categories"), field("URL").alias("product_url"),
    ).where("name is not null and tagline is not null")


def _members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for path, content in zip(frame["path"], frame["content"], strict=True):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                rows += [(path, name, z.read(name).decode("utf-8-sig", "replace")) for name in sorted(z.namelist()) if name.lower().endswith(".md")]
        yield pd.DataFrame(rows, columns=["path", "member", "body"])


def unescaped(text: Column) -> Column:
    """Markdown cells as text: every character entity as its character, line breaks as new lines, no blanks around; texts without an entity stay inside the engine."""

    @F.pandas_udf("string")
    def entities(some: pd.Series) -> pd.Series:
        return some.map(html.unescape, na_action="ignore")

    # by a conditional a UDF would see every row, so it gets nulls where there is nothing to do
    whole = F.when(F.contains(text, F.lit("&")), text)
    return stripped(F.regexp_replace(F.coalesce(entities(whole), text), r"(?i)<br\s*/?>", "\n"))


def markdown(spark: SparkSession, path: str, host: str) -> DataFrame:
    """Table rows `| [Name](url) | tagline ... <details>text</details> |` of markdown reports in ZIPs; later ones win."""
    files = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_members, "path string, member string, body string")
    lines = files.select("path", "member", F.posexplode(F.split("body", "\n")).alias("line", "value")).where(F.col("value").rlike(r"^\s*\|.*\]\(https?://"))
    part = lambda pattern: F.nullif(F.regexp_extract("value", pattern, 1), F.lit(""))
    url = part(r"\]\((https?://[^)\s]+)\)")
    details = part(r"(?s)<details>(?:\s*<summary>.*?</summary>)?(.*?)</details>")
    rows = lines.select("path", "member", "line", product_slug(url, host).alias("slug"), unescaped(part(r"\|\s*\[([^\]]*)\]\(")).alias("name"), unescaped(part(r"\)\s*\|\s*([^|<]*)")).alias("tagline"), unescaped(details).alias("description"), url.alias("product_url"))
    rows = rows.where("slug is not null and name is not null")
    best = rows.groupBy("slug").agg(F.max_by(F.struct("name", "tagline", "description", "product_url"), F.struct("path", "member", "line")).alias("r"))
    return best.select("slug", "r.*").withColumn("description", F.coalesce("description", "tagline"))
