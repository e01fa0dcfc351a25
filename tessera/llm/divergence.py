"""Audit of how far the sources of a language diverge, over term-block dense matrices.

The terms of a text are its runs of characters other than ASCII punctuation, digits, blanks and controls; only A-Z are
lower-cased. A language keeps the terms that occur in at least `least` of its documents (rows). Each (lang, source) group and each language gives
each kept term p = 1 + floor(10**9 (count + 1) / (N + V)), N being its occurrences of kept terms and V the number of these.
Two distributions p and q differ at a term by f = floor((p - q)**2 / q).

1. Tasks count the terms of their texts in a bounded dictionary, so that what is shuffled are sums and not words; texts are cut into pieces of
   1 MB at term ends, so that a text of any length is counted whole.
2. One exchange by (lang, term) serves the sums of each group and, by a window, the document counts that decide what is kept.
3. Kept counts are dealt into blocks of some BLOCK_TERMS terms, fewer where a language has many groups, so that a tile of counts, group by term in int64, has
   some CELLS cells at most. A block meets all groups of its language, computes p for its tile, and f of all pairs of groups by broadcasting
   strips of groups against the whole tile. Its pair matrix, summed over its terms, goes out as rows, which Spark sums over blocks;
   so does each group's heap of the `top` terms above the language's own p, and Spark keeps each group's best over all blocks.

All arithmetic is exact: p is found in three divisions by thousandths, which fit 64 bits to N + V of 9 * 10**15; beyond that it is an error.
Sums of f are decimals in Spark where blocks are summed, and cast to long.

Spark joins counts with groups, whose number is the length of the report; it broadcasts them only under its own size threshold. A hot source has no more rows than
its language has terms once the tasks have summed them.

Defined results: null text, lang and source are ''; a document without an id counts like any other, and so does a repeated row; a group without terms
has a row for every other source; a language without kept terms has pairs of 0 and no terms; extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

BLOCK_TERMS = 4096
CELLS = 1 << 20
#: Entries of a task's dictionary of counts, after which it is sent on.
HELD = 200_000
PIECE = 1 << 20
#: A-Z to a-z; every other ASCII byte but a-z to a blank; all bytes of longer characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a text, in lists that come from at most about `size` bytes (and one whole term)."""
    at = 0
    while at < len(text):
        folded = text[at : at + size].translate(_FOLD)
        if at + size < len(text) and (cut := folded.rfind(b" ")) + 1 < len(folded):
            if cut < 0:  # one term fills the piece: take all of it
                end = at + size
                while end < len(text) and text[end : end + 1].translate(_FOLD) != b" ":
                    end += 1
                folded = text[at:end].translate(_FOLD)
            else:
                folded = folded[: cut + 1]
        yield folded.split()
        at += len(folded)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's occurrences and documents of each term of each group."""
    held: dict[tuple[str, str], dict[bytes, list[int]]] = defaultdict(dict)
    entries = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            numbers = np.array(list(terms.values()), np.int64).reshape(-1, 2)
            columns = [pa.repeat(pa.scalar(lang), len(terms)), pa.repeat(pa.scalar(source), len(terms)), pa.array(list(terms), pa.binary()).cast(pa.string()), pa.array(numbers[:, 0]), pa.array(numbers[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        texts = batch["text"].cast(pa.binary() if pa.types.is_string(batch["text"].type) else pa.large_binary())
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts, strict=True):
            terms, seen = held[lang, source], set()
            for some in pieces(text.as_py()):
                for term in some:
                    if (entry := terms.get(term)) is None:
                        terms[term] = [1, 0]
                        entries += 1
                    else:
                        entry[0] += 1
                seen.update(some)
            for term in seen:
                terms[term][1] += 1
            if entries > HELD:
                yield from sent()
                terms, entries = None, 0
    yield from sent()


def term_counts(documents: DataFrame) -> DataFrame:
    """Partial counts (lang, source, term, n occurrences, docs): a row for each task at least."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = documents.select(blank("lang"), blank("source"), blank("text"))
    return rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")


def kept_counts(documents: DataFrame, least: int = 3) -> DataFrame:
    """(lang, source, term, n, first) of kept terms; `first` marks one row of each (lang, term)."""
    dealt = term_counts(documents).repartition(common.partitions(documents.sparkSession), "lang", "term")
    sums = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    rows = sums.withColumn("docs", F.sum("docs").over(term)).withColumn("first", F.row_number().over(term.orderBy("source")) == 1)
    return rows.where(F.col("docs") >= least).select("lang", "source", "term", "n", "first")


def groups(documents: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group: lang, source, its occurrences `total`, the language's terms `v`, groups `g`, blocks, and the group's number among them."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    every = documents.select(blank("lang"), blank("source")).distinct()
    found = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("v"))
    lang = Window.partitionBy("lang")
    rows = every.join(found, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
    rows = rows.withColumns({"v": F.sum("v").over(lang), "g": F.count(F.lit(1)).over(lang), "number": (F.row_number().over(lang.orderBy("source")) - 1).cast("int")})
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK_TERMS), F.floor(F.lit(CELLS) / F.col("g"))))
    return rows.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / width)).cast("int"))


def shares(counts: np.ndarray, totals: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(10**9 (count + 1) / (total + v)), exactly."""
    below = totals + v
    if below.size and int(below.max()) > (2**63 - 1) // 1000:
        raise OverflowError("more than 9 * 10**15 occurrences of a group")
    rest, out = counts + 1, np.zeros_like(counts)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digits
    return out + 1


def _tile(top: int):  # noqa: ANN202
    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        """The pair matrix and the heaps of one block."""
        lang = key[0].as_py()
        right = right.sort_by("number")
        v, totals, n_groups = right["v"][0].as_py(), right["total"].to_numpy(), right.num_rows
        pairs = np.zeros((n_groups, n_groups), np.int64)
        source, part, item, value = [], [], [], []
        if left.num_rows:
            words = left["term"].combine_chunks().dictionary_encode()
            names = words.dictionary.cast(pa.binary()).to_pylist()
            order = np.array(sorted(range(len(names)), key=names.__getitem__))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            counts = np.zeros((n_groups, len(names)), np.int64)
            counts[left["row"].to_numpy(), place[words.indices.to_numpy()]] = left["n"].to_numpy()
            p = shares(counts, totals[:, None], v)
            strip = max(1, CELLS // p.size)
            for at in range(0, n_groups, strip):
                away = p[at : at + strip, None, :] - p[None, :, :]
                pairs[at : at + strip] = (away * away // p[None, :, :]).sum(2)
            q = shares(counts.sum(0)[None, :], totals.sum()[None, None], v)
            away = p - q
            worth = np.where((counts > 0) & (away > 0), away * away // q, -1)
            for g in range(n_groups):
                best = np.argsort(-worth[g], kind="stable")[:top]  # columns stand in the order of the terms, so ties go to the smaller one
                best = best[worth[g][best] >= 0]
                source += [g] * len(best)
                item += [names[order[t]].decode() for t in best]
                value += worth[g][best].tolist()
            part = ["term"] * len(source)
        a, b = np.nonzero(~np.eye(n_groups, dtype=bool))
        sources = right["source"].combine_chunks()
        whose = pa.array(np.concatenate([np.array(source, np.int64), a]))
        return pa.table(
            {
                "lang": pa.array([lang] * len(whose), pa.string()),
                "source": sources.take(whose),
                "part": pa.array(part + ["pair"] * len(a), pa.string()),
                "item": pa.concat_arrays([pa.array(item, pa.string()), sources.take(pa.array(b)).cast(pa.string())]),
                "value": pa.array(np.concatenate([np.array(value, np.int64), pairs[a, b]])),
            }
        )

    return tile


def audit(documents: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of a language's sources, and each group's `top` terms."""
    kept = common.staged(kept_counts(documents, least), "divergence_kept")
    every = common.staged(groups(documents, kept), "divergence_groups")
    block = lambda x: F.pmod(F.xxhash64(x), F.col("parts")).cast("int").alias("block")
    own = every.select("lang", "source", F.col("number").alias("row"), F.col("blocks").alias("parts"))
    left = kept.join(own, ["lang", "source"]).select("lang", block("term"), "row", "term", "n")
    right = every.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "number", "total", "v")
    tiles = left.groupBy("lang", "block").cogroup(right.groupBy("lang", "block")).applyInArrow(_tile(top), "lang string, source string, part string, item string, value long")
    # a term lies in one block, so that only pairs have several values to sum
    sums = tiles.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place: Column = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    ranked = sums.withColumn("rank", place.cast("int"))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of every text of `documents`."""
    return audit(common.table(spark, sf_dir, "documents"))


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (t.total + v.v) AS p
  FROM t JOIN k ON k.lang = t.lang JOIN v ON v.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
q AS (
  SELECT k.lang, k.term, 1 + 1000000000::HUGEINT * (x.n + 1) // (y.total + v.v) AS q
  FROM k JOIN v ON v.lang = k.lang JOIN (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) x ON x.lang = k.lang AND x.term = k.term
  JOIN (SELECT lang, sum(total) AS total FROM t GROUP BY ALL) y ON y.lang = k.lang),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM v)
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 200"""

QUERIES = {"op12_divergence": op12_divergence}
SQL = {"op12_divergence": _SQL}
