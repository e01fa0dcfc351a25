"""Mix sources to target weights by Poisson replication.

A source's repetition rate is its target share of the output over its share of the corpus, counted in
characters. Each document draws its number of copies from a Poisson distribution with that mean by inverting
the distribution at a uniform number hashed from (seed, doc_id): the number of distribution values at or below
it. Documents are exploded by their counts and shuffled globally by a hash of (seed, doc_id, copy, text): it deals
the copies out to the partitions and orders them there, those of one id or of none too.

Rates and distribution tables have one row per source. They are broadcast while there are at most
`broadcast_sources` sources; beyond, they are joined by a shuffle whose skewed side adaptive execution splits.

Defined results: a null source is a source of its own, a source without a target weight gets none; a null text
has no characters but is drawn at its source's rate; a source of no characters at all is drawn at rate 1;
repeated rows draw alike, as the draw depends on the doc_id; a null doc_id draws as the text ''; extra columns
are kept, except for those named like the added ones (copy, copies, rate, shuffle_key), which are replaced;
an empty table gives no rows. A very long text is one row, as short ones are, and never leaves the JVM.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: 52 bits of a digest make a double in [0, 1) exactly.
_BITS = 52
_ADDED = ("copy", "copies", "rate", "shuffle_key", "_source", "_cdf", "_low")
#: Rates above this draw from a distribution that begins below their mean, not at 0.
_LARGE = 500.0


def _digest(*parts: Column) -> Column:
    """52 bits of the MD5 digest of the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, _BITS // 4), 16, 10).cast("long")


def temperature_weights(documents: DataFrame, alpha: float = 0.5) -> DataFrame:
    """(source, weight): each source's characters to the power alpha, so that large sources repeat less."""
    return source_sizes(documents).select("source", F.pow("chars", F.lit(alpha)).alias("weight"))


def source_sizes(documents: DataFrame) -> DataFrame:
    """(source, chars): the characters of each source."""
    chars = F.coalesce(F.sum(F.length(F.coalesce("text", F.lit(""))).cast("long")), F.lit(0)).cast("double")
    return documents.groupBy("source").agg(chars.alias("chars"))


def rates(documents: DataFrame, weights: DataFrame, epochs: float = 1.0, most: float | None = None) -> DataFrame:
    """The rates of `size_rates` for the sources of these documents."""
    return size_rates(source_sizes(documents), weights, epochs, most)


def size_rates(has: DataFrame, weights: DataFrame, epochs: float = 1.0, most: float | None = None) -> DataFrame:
    """(source, rate): copies expected of each document, so that the output holds `epochs` times the characters.

    `most`, where given, bounds how often a small source repeats; the mixture then misses its weights.
    """
    wanted = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double"))
    both = has.join(wanted, F.col("source").eqNullSafe(F.col("w_source")), "left").select("source", "chars", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    total = both.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight")).first()
    all_chars, all_weight = total["all_chars"] or 0.0, total["all_weight"] or 0.0
    # rounded, so that the order of addition does not show
    share = F.col("weight") * F.lit(epochs * all_chars) / F.lit(all_weight or 1.0)
    rate = F.when(F.col("chars") > 0, F.round(share / F.when(F.col("chars") > 0, F.col("chars")), 9)).otherwise(F.lit(1.0))
    if most is not None:
        rate = F.when(F.col("chars") > 0, F.least(rate, F.lit(most))).otherwise(rate)
    return both.select("source", rate.alias("rate"))


def _low(rate: Column) -> Column:
    """The least number of copies whose probability counts: 0, or at rates whose exp(-rate) is near underflow 12 deviations below."""
    return F.when(rate > _LARGE, F.ceil(rate - 12 * F.sqrt(rate))).otherwise(F.lit(0)).cast("int")


def _cdf(rate: Column) -> Column:
    """The Poisson distribution at _low, _low + 1, ..., up to where a double no longer tells it from 1."""
    low = _low(rate)
    n = low.cast("double")
    stirling = n * F.log(n) - n + F.log(2 * F.lit(pi) * n) / 2 + 1 / (12 * n) - 1 / (360 * n * n * n)  # ln n!
    first = F.when(rate > _LARGE, F.exp(n * F.log(rate) - rate - stirling)).otherwise(F.exp(-rate))
    steps = F.sequence(low + 1, F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int"))
    start = F.struct(first.alias("p"), F.array(first).alias("c"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(s["c"], F.array(F.element_at(s["c"], -1) + p)).alias("c"))

    return F.aggregate(steps, start, step, lambda s: s["c"])


def replicate(documents: DataFrame, source_rates: DataFrame, seed: int = 7, broadcast_sources: int = 10_000) -> DataFrame:
    """The documents with their copies, in a global random order; `copy` counts each document's copies from 0."""
    tables = source_rates.select(F.col("source").alias("_source"), "rate", _cdf(F.col("rate")).alias("_cdf"), _low(F.col("rate")).alias("_low"))
    if source_rates.count() <= broadcast_sources:
        tables = F.broadcast(tables)
    rows = documents.drop(*_ADDED)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    uniform = _digest(F.lit(str(seed)), ident) / F.lit(float(1 << _BITS))
    drawn = rows.join(tables, F.col("source").eqNullSafe(F.col("_source")))
    drawn = drawn.withColumn("copies", (F.col("_low") + F.size(F.filter("_cdf", lambda c: c <= uniform))).cast("long")).drop("_source", "_cdf", "_low")
    drawn = drawn.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    text = F.coalesce(F.md5(F.col("text").cast("string").cast("binary")), F.lit(""))
    drawn = drawn.withColumn("shuffle_key", _digest(F.lit(f"{seed}-order"), ident, F.col("copy").cast("string"), text))
    parts = common.partitions(documents.sparkSession)
    return drawn.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")


def mix(documents: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: int = 7, most: float | None = None) -> DataFrame:
    """Mix to the given weights, or to those of `temperature_weights` with a power of a half."""
    sizes = common.staged(source_sizes(documents), "sizes")
    weights = sizes.select("source", F.sqrt("chars").alias("weight")) if weights is None else weights
    return replicate(documents, common.staged(size_rates(sizes, weights, epochs, most), "rates"), seed)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every row of `documents` in the mixed order, with its text's digest."""
    rows = mix(common.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "copies", "copy", "shuffle_key", F.length("text").cast("long").alias("chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


QUERIES = {"op3_mixing": op3_mixing}
SQL = {
    "op3_mixing": """
WITH RECURSIVE
s AS (SELECT source, CAST(coalesce(sum(length(coalesce(text, ''))), 0) AS DOUBLE) AS chars FROM documents GROUP BY source),
t AS (SELECT sum(chars) AS all_chars, sum(pow(chars, 0.5)) AS all_weight FROM s),
r AS (SELECT source, CASE WHEN chars > 0 THEN round(pow(chars, 0.5) * (1.0::DOUBLE * all_chars) / all_weight / chars, 9) ELSE 1.0::DOUBLE END AS rate FROM s, t),
p AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS c FROM r
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), c + p * rate / (k + 1) FROM p WHERE k < ceil(rate + 12 * sqrt(rate) + 40)),
d AS (
  SELECT doc_id, source, text, CAST(CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
n AS (
  SELECT doc_id, d.source, text, (SELECT count(*) FROM p WHERE p.source IS NOT DISTINCT FROM d.source AND p.c <= d.u) AS copies FROM d),
e AS (SELECT doc_id, source, text, copies, unnest(range(copies)) AS copy FROM n WHERE copies > 0)
SELECT doc_id, source, copies, copy,
  CAST('0x' || substr(md5('7-order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy || ':' || coalesce(md5(text), '')), 1, 13) AS BIGINT) AS shuffle_key,
  CAST(length(text) AS BIGINT) AS chars, md5(text) AS text_md5
FROM e"""
}
