"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed from left to right into the
longest phrases that occur in a language's text (a letter that the language lacks opens the phrase behind it); the phrases times the bits that point into that text, per
letter, estimate the cross entropy. The language with the least wins.

The parse restarts at the automaton's start only, so automaton and restarts make one transition table per
language, over that language's own letters: a dense one for up to `DENSE` letters, sorted edges for more. The
tables, bounded by the letters learnt, go to every task, which parses the texts of a batch side by side, one letter
of each at a time. Texts are parsed in blocks of `BLOCK` letters, so that very long texts
take no longer per letter.

Defined results: null texts and texts without a letter are `und` with score 0; ties go to the language first
in order; repeated rows each keep a row; extra columns are left out; an empty table, or one without labelled
rows to learn from, gives `und` for every row; a null doc_id gives a null held_out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

BLOCK = 2048
#: Most letters of a language whose table is dense.
DENSE = 254
_GAP = 0xFFFFFFFF
_RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def sample_texts(documents: DataFrame, rows: int = 64, row_chars: int = 20_000) -> dict[str, list[str]]:
    """About `rows` whole labelled texts per language that may be learnt from, chosen by a hash of id and text.

    Rows of more than `row_chars` characters are learnt from only where a language has no other: then its shortest text is. Equal rows count once.
    """
    usable = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "lang").where("text is not null and lang is not null")
    usable = usable.where(~common.held_out(F.col("doc_id")))
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    usable = usable.withColumns({"draw": draw, "size": F.length("text")})
    counts = usable.groupBy(F.col("lang").alias("l")).agg(F.count_if(F.col("size") <= row_chars).alias("count"), F.min(F.struct("size", "draw")).alias("least"))
    short = (F.col("size") <= row_chars) & (F.col("draw") * F.col("count") < 1.5 * rows)
    alone = (F.col("count") == 0) & (F.col("size") == F.col("least.size")) & (F.col("draw") == F.col("least.draw"))
    some = usable.join(F.broadcast(counts), F.col("lang") == F.col("l")).where(short | alone)
    texts: dict[str, list] = {}
    for r in some.select("lang", "draw", "text").distinct().collect():
        texts.setdefault(r["lang"], []).append((r["draw"], r["text"]))
    return {lang: [t for _, t in sorted(found)[:rows]] for lang, found in sorted(texts.items())}


def _clean(text: str) -> str:
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton of a code sequence; none lead to 0, the start."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in codes:
        now = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = now
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return step


def _fitting(texts: list[str], chars: int) -> str:
    """As many of the texts, whole, as `chars` letters hold, in order; the shortest one if none fits."""
    clean, held, room = [c for c in map(_clean, texts) if c], [], chars
    for c in clean:
        if len(c) <= room:
            held.append(c)
            room -= len(c) + 1
    return " ".join(held or sorted(clean, key=len)[:1])


def fit(texts: dict[str, list[str]], chars: int = 24_000, dense_bytes: int = 256 << 20) -> dict:
    """The model: languages, letters of all, and for each language its table and bits a phrase.

    Each language learns from whole texts of some `chars` letters in all, however many languages there are. Its
    table is dense while all dense ones stay within `dense_bytes`; sorted edges take its place beyond, of some 40
    bytes a letter, with equal results.
    """
    joined = {lang: text for lang, some in texts.items() if (text := _fitting(some, chars))}
    letters = sorted(set("".join(joined.values())) | {" "})
    size = sum(8 * len(text) * (len(set(text)) + 1) for text in joined.values() if len(set(text)) <= DENSE)
    tables = [_table(text, letters, DENSE if size <= dense_bytes else 0) for text in joined.values()]
    return {"langs": list(joined), "letters": letters, "tables": tables, "bits": np.array([log2(len(text) + 1) for text in joined.values()])}


def _table(text: str, letters: list[str], dense_letters: int) -> dict:
    """A language's own codes of all letters (0: not its own) and its transitions; the lowest bit counts a new phrase."""
    code = {c: i + 1 for i, c in enumerate(sorted(set(text)))}
    step = automaton([code[c] for c in text])
    width = len(code) + 1
    own = np.array([0, *(code.get(c, 0) for c in letters)], np.int32)
    root = np.array([2 * step[0].get(c, 0) + 1 for c in range(width)], np.int32)
    keys = np.array([s * width + c for s, edges in enumerate(step) for c in sorted(edges)], np.int64)
    goals = np.array([2 * edges[c] for edges in step for c in sorted(edges)], np.int32)
    if width > dense_letters + 1:
        return {"own": own, "width": width, "root": root, "keys": keys, "goals": goals}
    dense = np.tile(root, len(step))
    dense[keys] = goals
    return {"own": own, "width": width, "dense": dense}


def _follow(table: dict, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
    at = state * table["width"] + codes
    if "dense" in table:
        return table["dense"][at]
    edge = np.minimum(np.searchsorted(table["keys"], at), len(table["keys"]) - 1)
    return np.where(table["keys"][edge] == at, table["goals"][edge], table["root"][codes])


def _code_points(model: dict) -> np.ndarray:
    """The code of every code point: a letter's, 0 for unknown letters, _GAP for what is no letter."""
    lut = np.full(0x110000, _GAP, np.uint32)
    code = {c: i + 1 for i, c in enumerate(model["letters"])}
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            lut[point] = code.get(c.lower(), 0)
    return lut


def phrases(texts: list[str | None], model: dict, lut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages) phrase counts and the letters and blanks parsed of each text."""
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    points = np.frombuffer("".join(t for t in texts if t).encode("utf-32-le", "surrogatepass"), "<u4")
    codes, owner = lut[points], np.repeat(np.arange(len(texts)), sizes)
    gap = codes == _GAP
    first = np.ones(len(codes), bool)
    first[1:] = owner[1:] != owner[:-1]
    before = np.ones(len(codes), bool)
    before[1:] = gap[:-1]
    keep = ~gap | ~(before | first)  # one blank between words
    codes, owner = np.where(gap, 1 + model["letters"].index(" "), codes)[keep], owner[keep]
    length = np.bincount(owner, minlength=len(texts))
    begins = np.cumsum(length) - length
    blocks = -(-length // BLOCK)
    block_owner = np.repeat(np.arange(len(texts)), blocks)
    within = np.arange(len(block_owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    block_start = begins[block_owner] + within * BLOCK
    block_size = np.minimum(BLOCK, length[block_owner] - within * BLOCK)
    order = np.argsort(-block_size, kind="stable")
    block_owner, block_start, block_size = block_owner[order], block_start[order], block_size[order]
    langs = len(model["langs"])
    count = np.zeros((langs, len(block_owner)), np.int64)
    active = np.searchsorted(-block_size, -np.arange(int(block_size.max()) if len(block_size) else 0), side="left").tolist()
    for lang, table in enumerate(model["tables"]):
        own, state = table["own"][codes], np.zeros(len(block_owner), np.int64)
        for t, k in enumerate(active):
            got = _follow(table, state[:k], own[block_start[:k] + t])
            if t:  # the first letter opens the first phrase
                count[lang, :k] += got & 1
            state[:k] = got >> 1
    total = np.zeros((len(texts), langs), np.int64)
    np.add.at(total, block_owner, count.T + 1)
    return total, length


def identify(documents: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred and a score in [0, 1] for every row, from its text alone."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most `dense_bytes`, or some 40 bytes for each letter learnt
    luts: list[np.ndarray] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if not luts:
            luts.append(_code_points(model))
        names = np.array([*model["langs"], "und"], object)
        for batch in common.slices(batches, size=4 << 20):
            texts = batch.column("text").to_pylist()
            pick, score = np.full(len(texts), len(model["langs"])), np.zeros(len(texts))
            if model["langs"]:
                count, length = phrases(texts, model, luts[0])
                entropy = count * model["bits"] / np.maximum(length, 1)[:, None]
                weight = np.exp2(-4 * (entropy - entropy.min(axis=1, keepdims=True)))
                some = length > 0
                pick[some] = entropy.argmin(axis=1)[some]
                score[some] = (weight.max(axis=1) / weight.sum(axis=1))[some]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[pick], pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = documents.select(F.col("doc_id").cast("long"), common.held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _RESULT)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every row of `documents`, learnt from the rows that are not held out."""
    documents = common.table(spark, sf_dir, "documents")
    return identify(documents, fit(sample_texts(documents)))


QUERIES = {"op10_language": op10_language}
SQL: dict[str, str] = {}
