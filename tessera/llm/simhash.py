"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A 64-bit fingerprint falls into three segments of 22, 21 and 21 bits. Each segment is decoded with the
(23, 12) Golay code to the indices of all codewords within four bits: one or six of them. Any two segments
that differ in two bits or fewer share an index. Four or fewer differing bits leave, by pigeonhole, either

- an unchanged segment beside one that differs in two bits or fewer: keys of a whole segment and an index; or
- segments that differ in two, one and one bits: keys of an index and an unchanged half of both others.

So linked fingerprints share a key of some 33 bits. Distinct fingerprints are shuffled by key, and each key's
fingerprints are compared exactly and joined to components by a search that drops what it has reached, so a
dense group gives a spanning forest, never all its pairs. Keys beyond `chunk` fingerprints are compared chunk
by chunk in further tasks. Equal fingerprints are joined beforehand, so copies cost nothing.

Defined results: null or empty texts, and texts of white space alone, have fingerprint zero and link to each
other; repeated rows each stay; a null doc_id gets the smallest known id of its component; extra columns are
left out; an empty table gives no rows. A text of any length is read as a whole by one task, its shingles in turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.components import apart, components

#: Longest runs of a key whose pairs are all compared at once.
_SMALL = 8
_BRANCHES = 32
#: The generator polynomial of the (23, 12) Golay code.
_GENERATOR = 0b101011100011


def _syndrome(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= _GENERATOR << (bit - 11)
    return v


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits; error patterns of weight four or less by syndrome; their number."""
    low = np.array([_syndrome(v) for v in range(1 << 12)], np.int64)
    high = np.array([_syndrome(v << 12) for v in range(1 << 11)], np.int64)
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            e = sum(1 << b for b in bits)
            found[int(low[e & 0xFFF] ^ high[e >> 12])].append(e)
    errors = np.full((1 << 11, max(map(len, found))), -1, np.int64)
    for s, patterns in enumerate(found):
        errors[s, : len(patterns)] = patterns
    return low, high, errors, (errors >= 0).sum(axis=1)


_tables: list = []


def codeword_indices(segments: np.ndarray) -> np.ndarray:
    """Rows of up to six 12-bit indices of the codewords within four bits of each 23-bit segment; -1 fills up."""
    if not _tables:
        _tables.extend(golay_tables())
    low, high, errors, _ = _tables
    e = errors[low[segments & 0xFFF] ^ high[segments >> 12]]
    return np.where(e < 0, -1, (segments[:, None] ^ e) >> 11)


#: Lowest bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint) for all keys of unsigned 64-bit fingerprints."""
    whole = [((fingerprints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    index = [codeword_indices(x) for x in whole]
    halves = [[(0 << 11) | (x & 0x7FF), (1 << 11) | (x >> 11)] for x in whole]  # the first bit says which half
    out, at, kind = [], [], 0

    def put(prefix: np.ndarray, of: np.ndarray) -> None:
        nonlocal kind
        row, col = np.nonzero(of >= 0)
        out.append((np.int64(kind) << 40) | (prefix[row] << 12) | of[row, col])
        at.append(row)
        kind += 1

    for i in range(3):
        j, k = (x for x in range(3) if x != i)
        for other in (j, k):
            put(whole[i], index[other])
        for a in halves[j]:
            for b in halves[k]:
                put(a << 12 | b, index[i])
    return np.concatenate(out), np.concatenate(at)


def fingerprints(documents: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of the whole text, as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in common.slices(batches, rows=512, size=2 << 20):
            result = np.zeros(batch.num_rows, np.uint64)
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.lower().split() if text else []
                if not words:
                    continue
                line = b" ".join(words)
                ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
                n = max(1, len(words) - shingle + 1)
                begins = [0, *ends[: n - 1].tolist()]
                stops = (ends[-n:] - 1).tolist()
                ones = np.zeros(64, np.int64)
                for s in range(0, n, 1 << 16):
                    h = np.array([digest(line[a:b], seed) for a, b in zip(begins[s : s + (1 << 16)], stops[s : s + (1 << 16)], strict=True)], "<u8")
                    ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
                result[i] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(result.view(np.int64))], ["doc_id", "fp"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest that joins linked fingerprints; each is compared with what is not yet reached.

    What one fingerprint reaches hangs on it as a tree of `_BRANCHES` children a node, so that none has very many edges.
    """
    left, one, two = fps, [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            f = front.pop()
            near = np.bitwise_count(left ^ f) <= distance
            if near.any():
                got = left[near]
                one.append(np.concatenate([[f], got])[np.arange(len(got)) // _BRANCHES])
                two.append(got)
                front.extend(got)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *one]), np.concatenate([none, *two])


def _near(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges among the fingerprints of each run of equal keys."""
    cut = np.flatnonzero(np.diff(key)) + 1
    begins, sizes = np.concatenate([[0], cut]), np.diff(np.concatenate([[0], cut, [len(key)]]))
    one, two = [], []
    for m in range(2, _SMALL + 1):
        runs = fp[begins[sizes == m][:, None] + np.arange(m)]
        for i in range(m):
            for j in range(i):
                ok = np.bitwise_count(runs[:, i] ^ runs[:, j]) <= distance
                one.append(runs[ok, i])
                two.append(runs[ok, j])
    for b, m in zip(begins[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist(), strict=True):
        a, c = _forest(fp[b : b + m], distance)
        one.append(a)
        two.append(c)
    edges = np.unique(np.column_stack([np.concatenate(one), np.concatenate(two)]), axis=0)
    return edges[:, 0], edges[:, 1]


def links(distinct: DataFrame, distance: int = 4, chunk: int = 4096) -> DataFrame:
    """Edges (a, b) between fingerprints `fp` of a table of distinct ones that join all within `distance` bits."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, rows=2048):
            fp = batch.column("fp").to_numpy()
            k, at = keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(fp[at])], ["key", "fp"])

    def out(a: np.ndarray, b: np.ndarray, chunks: list[tuple[int, int, np.ndarray]] = ()) -> pa.RecordBatch:
        n, none = len(a), [None]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*a.view(np.int64).tolist(), *(none * len(chunks))], pa.int64()),
                pa.array([*b.view(np.int64).tolist(), *(none * len(chunks))], pa.int64()),
                pa.array([*(none * n), *(c[0] for c in chunks)], pa.int64()),
                pa.array([*(none * n), *(c[1] for c in chunks)], pa.int64()),
                pa.array([*(none * n), *(c[2].tobytes() for c in chunks)], pa.binary()),
            ],
            ["a", "b", "key", "chunk", "fps"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        number, chunked = 0, False  # chunks of the key that goes on

        def close(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            """The last, cut, chunk of a key of several joins its earlier ones."""
            nonlocal number, chunked
            chunks = []
            if chunked:
                m = int(np.searchsorted(k, k[0], side="right"))
                chunks = [(int(k[0]), number, f[:m])]
            number, chunked = 0, False
            return out(*_near(k, f, distance), chunks)

        for batch in batches:
            k = np.concatenate([rest_key, batch.column("key").to_numpy()])
            f = np.concatenate([rest_fp, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1], side="left"))
            if last:
                yield close(k[:last], f[:last])
                k, f = k[last:], f[last:]
            while len(k) > chunk:
                yield out(*_forest(f[:chunk], distance), [(int(k[0]), number, f[:chunk])])
                k, f, number, chunked = k[chunk:], f[chunk:], number + 1, True
            rest_key, rest_fp = k, f
        if len(rest_key):
            yield close(rest_key, rest_fp)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = _forest(np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)]), distance)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    spark = distinct.sparkSession
    keyed = distinct.mapInArrow(key, "key long, fp long").repartition(common.partitions(spark), "key").sortWithinPartitions("key")
    found = common.staged(keyed.mapInArrow(compare, "a long, b long, key long, chunk long, fps binary"), "links")
    edges = found.where("a is not null").select("a", "b")
    large = found.where("chunk is not null")
    if large.isEmpty():
        return edges
    one = large.select("key", F.col("chunk").alias("c"), F.col("fps").alias("x"))
    two = large.select(F.col("key").alias("key2"), F.col("chunk").alias("d"), F.col("fps").alias("y"))
    pairs = one.join(two, (F.col("key") == F.col("key2")) & (F.col("c") < F.col("d"))).select("x", "y")
    return edges.union(pairs.repartition(common.partitions(spark)).mapInArrow(across, "a long, b long"))


def near_duplicates(documents: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id it can reach."""
    marked = common.staged(fingerprints(documents, shingle), "fingerprints")
    distinct = common.staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    # nodes are ordered by id, so a component's root tells its smallest id; fingerprints without an id come last
    nodes = distinct.select("fp", F.struct(F.col("first_id").isNull().alias("last"), F.col("first_id").alias("id"), "fp").alias("node"))
    ends = [nodes.select(F.col("fp").alias(f"f{x}"), F.col("node").alias(f"node_{x}")) for x in "ab"]
    edges = links(distinct.select("fp"), distance).join(ends[0], F.col("a") == F.col("fa")).join(ends[1], F.col("b") == F.col("fb"))
    roots = components(edges, "node_a", "node_b").select(F.col("node.fp").alias("of_fp"), F.col("root.id").alias("least_id"))
    of = distinct.join(roots, F.col("fp") == F.col("of_fp"), "left").select(apart("fp").alias("k"), F.coalesce("least_id", "first_id").alias("component_id"))
    return marked.join(of, F.col("fp") == F.col("k")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of `documents`."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))


QUERIES = {"op4_simhash": op4_simhash}
SQL: dict[str, str] = {}
