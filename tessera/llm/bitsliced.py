"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers, numbered, and dealt into blocks of some `block_rows` rows by a hash of their
number, so that rows of one id spread too. A block holds, for every component and bit, the bitmap of the rows with that bit set. For a query, the bitmaps
that its components' binary digits pick are added with carry-save bitmap arithmetic into the slices of all
rows' scores. The top rows are selected from the most significant slice downward; rows still equal after the
last slice are the boundary, which is resolved exactly by the smaller id. Each query's best rows of all blocks
are then merged.

Blocks and queries meet in a grid: blocks fall into r groups and queries into c, a task compares one group with the
other, and so each block travels c times and each query r times, with r and c about the root of their numbers. A
task holds its queries and reads its blocks one by one. No row or bit is left out, so results are exact at every size.

Defined results: vectors that are null or hold null, NaN or infinite components take no part, nor do rows
without an id; rows of one id are rows of their own, each a query where the filter picks it and a candidate for the
others; shorter vectors have zeros behind; a component of 2**61 or more after quantisation, or a score beyond 64
bits, is an error; ties go to the smaller id; extra columns are left out; an empty table, or one without queries,
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

_INDEX = "block int, dims int, bits int, ids binary, numbers binary, slices binary"
_LIMIT = float(1 << 61)


def quantised(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, v): every usable vector, as integers floor(scale * x)."""
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    some = some.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(finite)

    def whole(x: Column) -> Column:
        large = F.abs(x * F.lit(scale)) >= F.lit(_LIMIT)
        return F.when(large, F.raise_error(F.lit("a component is too large")).cast("long")).otherwise(F.floor(x * F.lit(scale)).cast("long"))

    return some.select("vec_id", F.transform("v", whole).alias("v"))


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """One row per block of the numbered vectors: ids and numbers in order and the bitmaps of every component's offset-binary bits, lowest first."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("number", "ascending")])
        vec = table["v"].combine_chunks()
        sizes = np.diff(vec.offsets.to_numpy())
        dims, n = int(sizes.max()), len(sizes)
        values = np.zeros((n, dims), np.int64)
        values[np.arange(dims)[None, :] < sizes[:, None]] = vec.flatten().to_numpy()
        most = int(np.abs(values).max()) if values.size else 0
        bits = max(1, most.bit_length()) + 1
        raised = values + (1 << (bits - 1))  # offset binary: never negative
        words = -(-n // 64)
        out = np.zeros((dims, bits, words), "<u8")
        for d in range(dims):
            for b in range(bits):
                packed = np.packbits((raised[:, d] >> b & 1).astype(np.uint8), bitorder="little")
                out[d, b] = np.frombuffer(packed.tobytes().ljust(words * 8, b"\0"), "<u8")
        ids, numbers = (table[c].to_numpy().astype("<i8").tobytes() for c in ("vec_id", "number"))
        row = {"block": table["block"][0].as_py(), "dims": dims, "bits": bits, "ids": ids, "numbers": numbers, "slices": out.tobytes()}
        return pa.table({name: pa.array([x], pa.binary() if isinstance(x, bytes) else pa.int32()) for name, x in row.items()})

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int"))
    return dealt.select("block", "number", "vec_id", "v").groupBy("block").applyInArrow(build, _INDEX)


def _digits(x: int) -> list[tuple[int, int]]:
    """(position, +1 or -1) of the non-adjacent form of x."""
    found, p = [], 0
    while x:
        if x & 1:
            d = 2 - (x & 3)
            found.append((p, d))
            x -= d
        x >>= 1
        p += 1
    return found


def add_slices(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of sum(query * row), lowest first, and what to take off that sum.

    slices: components x bits x words. Carry-save adders turn three bitmaps of one weight into one of it and
    one of the next.
    """
    bits, words = slices.shape[1:]
    plus: dict[int, list[tuple[int, int]]] = {}
    minus: dict[int, list[tuple[int, int]]] = {}
    off = 0
    for d, q in enumerate(query.tolist()[: len(slices)]):
        off += q << (bits - 1)
        for p, sign in _digits(q):
            if sign < 0:
                off += ((1 << bits) - 1) << p  # -u is its complement less all ones
            for b in range(bits):
                (plus if sign > 0 else minus).setdefault(p + b, []).append((d, b))
    out, carries, p = [], np.zeros((0, words), np.uint64), 0
    top = max([*plus, *minus], default=-1)
    while p <= top or len(carries):
        parts = [carries]
        if p in plus:
            d, b = np.array(plus[p]).T
            parts.append(slices[d, b])
        if p in minus:
            d, b = np.array(minus[p]).T
            parts.append(~slices[d, b])
        now, up = np.concatenate(parts), []
        while len(now) > 1:
            m = len(now) // 3
            if m:
                a, b, c = now[:m], now[m : 2 * m], now[2 * m : 3 * m]
                x = a ^ b
                up.append((a & b) | (x & c))
                now = np.concatenate([x ^ c, now[3 * m :]])
            else:
                up.append(now[:1] & now[1:])
                now = now[:1] ^ now[1:]
        out.append(now[0] if len(now) else np.zeros(words, np.uint64))
        carries = np.concatenate(up) if up else carries[:0]
        p += 1
    return out, off


def _set_bits(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(sums: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """The k rows of bitmap `rows` with the largest sums, ties to the lower row, from the top slice downward."""
    sure, edge = np.zeros_like(rows), rows
    count = lambda x: int(np.bitwise_count(x).sum())
    for s in reversed(sums):
        tried = sure | (edge & s)
        n = count(tried)
        if n > k:
            edge = edge & s
        elif n < k:
            sure, edge = tried, edge & ~s
        else:
            return _set_bits(tried)
    return np.concatenate([_set_bits(sure), _set_bits(edge)[: k - count(sure)]])


def _best(row: dict, queries: list[tuple[int, int, np.ndarray]], k: int) -> pa.RecordBatch:
    """The k best rows of one block for each query (number, id, vector)."""
    ids, numbers = (np.frombuffer(row[c], "<i8") for c in ("ids", "numbers"))
    slices = np.frombuffer(row["slices"], "<u8").reshape(row["dims"], row["bits"], -1).astype(np.uint64)
    whole = np.full(slices.shape[2] if slices.size else -(-len(ids) // 64), ~np.uint64(0))
    if len(ids) % 64:
        whole[-1] = np.uint64((1 << (len(ids) % 64)) - 1)
    place = dict(zip(numbers.tolist(), range(len(numbers)), strict=True))
    found = []
    for number, vec_id, v in queries:
        sums, off = add_slices(slices, v)
        rows, own = whole, place.get(number)
        if own is not None:
            rows = whole.copy()
            rows[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        for r in select_top(sums, rows, k).tolist():
            total = sum(1 << p for p, s in enumerate(sums) if int(s[r // 64]) >> (r % 64) & 1)
            found.append((number, vec_id, int(ids[r]), total - off))
    columns = zip(*found, strict=True) if found else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["number", "query_id", "vec_id", "score"])


def search(index: DataFrame, queries: DataFrame, blocks: int, k: int, query_rows: int = 512) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of the index for each query (number, vec_id, v), without itself.

    Groups of queries hold `query_rows` of them times the root of such groups' number, groups of blocks likewise, but
    there are groups of blocks enough for all partitions.
    """
    parts = common.partitions(queries.sparkSession)
    columns = max(1, math.isqrt(-(-queries.count() // query_rows)))
    rows = max(1, min(blocks, max(math.isqrt(blocks), parts)))
    deal = lambda key, n: F.pmod(F.xxhash64(F.lit("grid"), key), F.lit(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blank = lambda kind: F.lit(None).cast(kind)
    held = index.select(F.pmod("block", F.lit(rows)).alias("r"), other(columns).alias("c"), F.lit(1).alias("kind"), "dims", "bits", "ids", "numbers", "slices", blank("long").alias("number"), blank("long").alias("vec_id"), blank("array<long>").alias("v"))
    asked = queries.select(other(rows).alias("r"), deal("number", columns).alias("c"), F.lit(0).alias("kind"), *(blank("int").alias(x) for x in ("dims", "bits")), *(blank("binary").alias(x) for x in ("ids", "numbers", "slices")), "number", "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, group = None, []
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                for row in batch.slice(i, 64).to_pylist():
                    if (row["r"], row["c"]) != cell:
                        cell, group = (row["r"], row["c"]), []
                    if row["kind"] == 0:
                        group.append((row["number"], row["vec_id"], np.array(row["v"], np.int64)))
                    elif group:
                        yield _best(row, group, k)

    met = held.union(asked).repartition(parts, "r", "c").sortWithinPartitions("r", "c", "kind")
    best = met.mapInArrow(run, "number long, query_id long, vec_id long, score long")
    # at most k rows of each block meet here, partly merged before the shuffle
    order = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, k: int = 5, query_filter: str = "vec_id % 50 = 0", block_rows: int = 8192) -> DataFrame:
    """Index every usable vector and search it for those that `query_filter` picks."""
    vectors = common.staged(quantised(rows).select(F.monotonically_increasing_id().alias("number"), "vec_id", "v"), "vectors")
    blocks = max(1, -(-vectors.count() // block_rows))
    return search(build_index(vectors, blocks), vectors.where(query_filter), blocks, k)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of `embeddings` for each row whose id is divisible by 50."""
    return top_k(common.table(spark, sf_dir, "embeddings"))


QUERIES = {"op2_topk": op2_topk}
SQL = {
    "op2_topk": """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.n <> c.n WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
}
