"""Captured files as DataFrames: capture indexes, site maps, archived responses, dumps and zipped exports.

Line formats are split and parsed by built-in functions; only container formats go through a small helper.
"""

from __future__ import annotations

import csv
import gzip
import io
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import product_slug
from tessera.sources.sections import section_objects

_CDX = "url string, timestamp string, status string, filename string, `offset` string, length string, mime string"
#: Path heads of current and retired launch pages. Fixed values.
LEGACY_ROUTES = ("apps", "books", "games", "podcasts", "posts", "products", "tech")


def cdx_json(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of JSON objects: the capture's fields, `malformed` where the line is no object with a url."""
    got = F.from_json(column, _CDX)
    return lines.select(column, got.alias("c")).select("c.*", F.col("c.url").isNull().alias("malformed"))


def cdx_block(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of key, timestamp and JSON object."""
    parts = F.split(column, " ", 3)
    got = F.from_json(F.get(parts, F.lit(2)), _CDX)
    return lines.select(F.get(parts, F.lit(0)).alias("surt"), got.alias("c"), F.get(parts, F.lit(1)).alias("at")).select(
        "surt", "c.url", F.coalesce("c.timestamp", "at").alias("timestamp"), "c.status", "c.filename", "c.offset", "c.length", "c.mime", F.col("c.url").isNull().alias("malformed")
    )


def cdx_fields(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines of eleven blank-separated fields."""
    parts = F.split(column, " ")
    short = F.size(parts) < 11
    at = lambda i: F.when(~short, F.get(parts, F.lit(i)))
    return lines.select(at(0).alias("surt"), at(1).alias("timestamp"), at(2).alias("url"), at(3).alias("mime"), at(4).alias("status"), at(8).alias("length"), at(9).alias("offset"), at(10).alias("filename"), short.alias("malformed"))


def urls_in(lines: DataFrame, host: str, kind: str, column: str = "value") -> DataFrame:
    """Distinct slugs of all addresses of a host anywhere in the lines."""
    each = F.explode(F.regexp_extract_all(column, F.lit(r'https?://[^\s"\\]+'), F.lit(0)))
    return lines.select(each.alias("url")).select(product_slug(F.col("url"), host, kind).alias("slug")).where("slug is not null").distinct()


def legacy_route(url: Column, host: str) -> Column:
    """struct(route, slug) of a current or retired launch address, or null."""
    pattern = rf"(?i)^https?://(?:www\.)?{host.replace('.', chr(92) + '.')}/({'|'.join(LEGACY_ROUTES)})/([^/?#]+)"
    slug = F.lower(F.regexp_extract(url, pattern, 2))
    return F.when(slug.rlike("^[a-z0-9][a-z0-9-]*$") & (F.length(slug) <= 300), F.struct(F.lower(F.regexp_extract(url, pattern, 1)).alias("route"), slug.alias("slug")))


def best_captures(captures: DataFrame, targets: DataFrame, host: str, kind: str) -> DataFrame:
    """Per wanted slug the successful capture of its own page that is newest, without a query, and longest."""
    exact = F.regexp_extract("url", rf"(?i)^https?://(?:www\.)?{host.replace('.', chr(92) + '.')}/{kind}/([^/?#]+)/?(\?[^#]*)?$", 1)
    rows = captures.where((F.col("status") == "200") & ~F.col("malformed")).withColumn("slug", F.lower(F.nullif(exact, F.lit("")))).where("slug is not null")
    rank = F.struct("timestamp", (~F.contains(F.col("url"), F.lit("?"))).alias("plain"), F.col("length").try_cast("long").alias("n"))
    best = rows.join(targets.select("slug"), "slug", "left_semi").groupBy("slug").agg(F.max_by(F.struct("timestamp", "url", "filename", "offset", "length"), rank).alias("c"))
    return best.select("slug", "c.*")


def _per_file(frames: Iterator[pd.DataFrame], rows_of, columns: list[str]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [(path, i, *row) for path, content in zip(frame["path"], frame["content"], strict=True) for i, row in enumerate(rows_of(bytes(content)))]
        yield pd.DataFrame(rows, columns=["path", "ordinal", *columns])


def sitemap_rows(content: bytes) -> list[tuple[str, str, str | None]]:
    """(kind, address, last change) of a site map or an index of site maps, gzipped or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    root = ElementTree.fromstring(content)
    local = lambda e: e.tag.rpartition("}")[2]
    out = []
    for entry in root:
        fields = {local(x): (x.text or "").strip() for x in entry}
        if fields.get("loc"):
            out.append(("index" if local(root) == "sitemapindex" else "page", fields["loc"], fields.get("lastmod") or None))
    return out


def sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of the site maps in a folder."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(lambda it: _per_file(it, sitemap_rows, ["kind", "loc", "lastmod"]), "path string, ordinal long, kind string, loc string, lastmod string")


def sitemap_products(entries: DataFrame, host: str) -> DataFrame:
    """(slug, lastmod): products named in page entries, with their latest change."""
    rows = entries.where("kind = 'page'").select(product_slug(F.col("loc"), host, most=255).alias("slug"), F.try_to_timestamp("lastmod").alias("lastmod"))
    return rows.where("slug is not null").groupBy("slug").agg(F.max("lastmod").alias("lastmod"))


def _zip_rows(content: bytes) -> list[tuple[str, str]]:
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in sorted(n for n in z.namelist() if n.lower().endswith(".csv")):
            reader = csv.DictReader(io.StringIO(z.read(name).decode("utf-8-sig")))
            out += [(name, {k: v for k, v in row.items() if k}) for row in reader]
    return out


def zipped_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the CSV members of ZIP files, as maps, in the order of members and rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(lambda it: _per_file(it, _zip_rows, ["member", "fields"]), "path string, ordinal long, member string, fields map<string,string>")


def last_per_slug(rows: DataFrame, slug: Column) -> DataFrame:
    """Later rows of a slug win."""
    keyed = rows.withColumn("slug", slug).where("slug is not null")
    return keyed.groupBy("slug").agg(F.max_by("fields", F.struct("path", "ordinal")).alias("fields"))


def sectioned_json(spark: SparkSession, path: str, section: str, following: str, schema: str) -> DataFrame:
    """Objects, one a line, between the lines that open a section and the next one of a dump; many tasks read one file."""
    return section_objects(spark, path, section, following, schema).select("r.*")


def http_body(record: bytes) -> bytes | None:
    """Body of the HTTP response in an archived record, with chunks joined and compression undone; null if broken."""
    try:
        if record[:2] == b"\x1f\x8b":
            record = gzip.decompress(record)
        _, _, rest = record.partition(b"\r\n\r\n") if record.startswith(b"WARC/") else (b"", b"", record)
        head, mark, body = rest.partition(b"\r\n\r\n")
        if not mark:
            return None
        fields = {k.strip().lower(): v.strip().lower() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
        if b"chunked" in fields.get(b"transfer-encoding", b""):
            parts, at = [], 0
            while True:
                end = body.index(b"\r\n", at)
                size = int(body[at:end].partition(b";")[0], 16)
                if not size:
                    break
                parts.append(body[end + 2 : end + 2 + size])
                at = end + 4 + size
            body = b"".join(parts)
        kind = fields.get(b"content-encoding", b"")
        if kind == b"gzip":
            return gzip.decompress(body)
        if kind == b"deflate":
            return zlib.decompressobj(-15 if body[:1] != b"\x78" else 15).decompress(body)
        return body
    except (ValueError, OSError, zlib.error):
        return None


def bodies(records: Column) -> Column:
    @F.pandas_udf("binary")
    def run(some: pd.Series) -> pd.Series:
        return some.map(lambda r: http_body(bytes(r)) if r is not None else None)

    return run(records)
