"""Sorted indexes of captures: which byte ranges of a block-compressed file hold a key range, and paged listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that one range of a file may have.
MOST_BYTES = 128 << 20


def block_index(lines: DataFrame, file: str = "file", column: str = "value") -> DataFrame:
    """(file, key, offset, length) of tab-separated index lines: key and time, part, offset, length; others go."""
    parts = F.split(column, "\t")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("long")
    rows = lines.select(F.col(file).alias("file"), F.split(F.get(parts, F.lit(0)), " ", 2)[0].alias("key"), number(2).alias("offset"), number(3).alias("length"))
    return rows.where("offset is not null and length is not null")


def hit_ranges(blocks: DataFrame, prefix: str, most: int = MOST_BYTES) -> DataFrame:
    """Per file the bytes from the block before the first key with a prefix to the end of the block after the last.

    `problem` names files without such a key and ranges of more than `most` bytes. Blocks are ordered by offset.
    """
    hits = blocks.where(F.startswith("key", F.lit(prefix))).groupBy("file").agg(F.min("offset").alias("first"), F.max("offset").alias("last"))
    end = (F.col("offset") + F.col("length")).alias("end")
    block = F.struct("offset", end)
    after = F.min(F.when(F.col("offset") > F.col("last"), block))["end"]
    ranges = (
        blocks.join(hits, "file", "left")
        .groupBy("file")
        .agg(F.coalesce(F.max(F.when(F.col("offset") < F.col("first"), F.col("offset"))), F.min("first")).alias("start"), F.coalesce(after, F.max(F.when(F.col("offset") == F.col("last"), block))["end"]).alias("stop"))
    )
    problem = F.when(F.col("start").isNull(), "no key").when(F.col("stop") - F.col("start") > most, "too large")
    return ranges.select("file", "start", (F.col("stop") - F.col("start")).alias("length"), problem.alias("problem"))


def key_range(blocks: DataFrame, low: str, high: str) -> DataFrame:
    """Per file the blocks with low <= key < high and the last one below low, whose lines may reach into the range."""
    names = ("file", "key", "offset", "length")
    inside = blocks.where((F.col("key") >= low) & (F.col("key") < high)).select(*names)
    before = blocks.where(F.col("key") < low).groupBy("file").agg(F.max(F.struct("key", "offset", "length")).alias("r"))
    return inside.union(before.select("file", "r.key", "r.offset", "r.length"))


def resume_page(body: Column) -> Column:
    """struct(urls, resume_key) of a page of addresses; the key stands after the last empty line, if there is one."""
    text = F.regexp_replace(body, r"\n+\z", "")
    key = F.nullif(F.regexp_extract(text, r"(?s)^.*\n\n(.*)\z", 1), F.lit(""))
    key = F.when(~F.contains(key, F.lit("://")), key)
    rest = F.when(key.isNotNull(), F.regexp_extract(text, r"(?s)^(.*)\n\n.*\z", 1)).otherwise(text)
    urls = F.filter(F.split(rest, "\n"), lambda u: u != "")
    return F.struct(urls.alias("urls"), key.alias("resume_key"))


def products_file(spark: SparkSession, path: str) -> DataFrame:
    """A table by its suffix: .parquet, or .csv with a header line."""
    suffix = path.rpartition(".")[2].lower()
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "csv":
        return spark.read.csv(path, header=True, inferSchema=True, multiLine=True, escape='"')
    raise ValueError(f"neither .parquet nor .csv: {path}")


def reachable(entries: DataFrame, roots: list[str], most: int = 10_000) -> DataFrame:
    """Page entries of the site maps that can be reached from the roots; entries are (map, kind, loc, lastmod).

    Only addresses of site maps travel to the driver, at most `most` of them; more are an error, as is another scheme.
    """
    seen: set[str] = set()
    links = entries.where("kind = 'index'").select("map", "loc")
    new = set(roots)
    while new:
        if wrong := [u for u in new if not u.startswith(("http://", "https://"))]:
            raise ValueError(f"unsupported address of a site map: {wrong[0]}")
        seen |= new
        if len(seen) > most:
            raise ValueError(f"more than {most} site maps")
        found = links.where(F.col("map").isin(*new)).select("loc").distinct().limit(most + 1).collect()
        new = {r["loc"] for r in found} - seen
    return entries.where((F.col("kind") == "page") & F.col("map").isin(*seen))


#: The letters and digits that a listing is split by where it can't be had whole.
PREFIXES = "abcdefghijklmnopqrstuvwxyz0123456789"


def prefix_listing(pages: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(addresses, report) of a listing that was read prefix by prefix.

    pages: prefix, page from 0, url (null for a malformed line); counts: prefix, pages as the service reported them. The report has a row for each of PREFIXES: pages
    reported and read, lines, malformed lines and distinct addresses, and `problem`: not asked, pages missing, pages too many, or addresses of another prefix.
    Addresses come once each, from prefixes without a problem only, so that a partial listing isn't taken for a whole one.
    """
    spark = pages.sparkSession
    every = spark.createDataFrame([(p,) for p in PREFIXES], "prefix string")
    last = F.lower(F.regexp_extract("url", r"^[^?#]*/([^/?#]*)", 1))
    read = pages.groupBy("prefix").agg(
        F.count_distinct("page").alias("pages_read"), F.max("page").alias("_last"), F.count(F.lit(1)).alias("lines"), F.count_if(F.col("url").isNull()).alias("malformed"), F.count_distinct("url").alias("addresses"),
        F.count_if(F.coalesce(~F.startswith(last, F.col("prefix")), F.lit(False))).alias("_foreign"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    reported = counts.groupBy("prefix").agg(F.max("pages").cast("long").alias("pages"))
    rows = every.join(reported, "prefix", "left").join(read, "prefix", "left")
    problem = (
        F.when(F.col("pages").isNull(), "not asked")
        .when(F.coalesce("pages_read", F.lit(0)) < F.col("pages"), "pages missing")
        .when(F.coalesce(F.col("_last") >= F.col("pages"), F.lit(False)), "pages too many")
        .when(F.coalesce("_foreign", F.lit(0)) > 0, "addresses of another prefix")
    )
    report = rows.select("prefix", "pages", *(zero(c) for c in ("pages_read", "lines", "malformed", "addresses")), problem.alias("problem"))
    good = report.where("problem IS NULL").select("prefix")
    return pages.where("url IS NOT NULL").join(F.broadcast(good), "prefix", "left_semi").select("url").distinct(), report
