"""Packing by non-negative least squares over a histogram of lengths.

Documents are encoded once into a staged table. Whole windows are cut off each document; what remains is
counted in length units. Shallow combinations (at most three lengths) that fill a window exactly are
enumerated, and the number of times each is used is the non-negative least-squares solution against the
histogram. Every task then takes its documents in bounded groups, uses each combination its rounded share of
times while lengths last, and packs what is left by best fit, longest first.

Only the histogram (at most one row per unit) reaches the driver, and only the combinations in use go back.

Defined results: a null or empty text has the end id alone; repeated rows are packed each on its own; rests of one
length go in the order of the staged table; extra columns are left out; an empty table gives no rows. A text of any
length is encoded whole by one task, and its whole windows are sequences of their own.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, encoding

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def encode_documents(documents: DataFrame, vocabulary: str = encoding.BYTE_BPE, end_id: int = 1) -> DataFrame:
    """doc_id, n_tokens and the ids as little-endian unsigned 32-bit integers, in a staged table."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoding.encoder(vocabulary)
        for batch in common.slices(batches):
            ids, starts = encoding.with_end(*tool.encode(batch.column("text")), end_id)
            raw = pa.py_buffer(ids.astype("<u4").tobytes())
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((starts * 4).astype(np.int64).tobytes()), raw])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(starts)), data.cast(pa.binary())], ["doc_id", "n_tokens", "ids"]
            )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return common.staged(rows.mapInArrow(encode, "doc_id long, n_tokens long, ids binary"), "ids")


def combinations(units: int) -> np.ndarray:
    """All multisets of at most three positive lengths that add up to `units`, padded with zeros."""
    found = [(units, 0, 0)] + [(units - a, a, 0) for a in range(1, units // 2 + 1)]
    found += [(units - a - b, b, a) for a in range(1, units // 3 + 1) for b in range(a, (units - a) // 2 + 1)]
    return np.array(found, np.int64)


def solve(counts: np.ndarray) -> list[tuple[tuple[int, ...], float]]:
    """Use counts x >= 0 of the combinations that minimise |A x - counts|, by the active-set method.

    counts[u] is the number of pieces of u units; counts[0] is unused.
    """
    units = len(counts) - 1
    combos = combinations(units)
    total = counts[1:].sum()
    if not total:
        return []
    target = counts.astype(float) / total
    target[0] = 0

    def column(k: int) -> np.ndarray:
        out = np.zeros(units + 1)
        np.add.at(out, combos[k], 1)
        out[0] = 0
        return out

    used: list[int] = []
    matrix, x = np.zeros((units + 1, 0)), np.zeros(0)
    for _ in range(30 * units):  # far more than the method takes; a rest beyond them is packed by best fit
        rest = target - matrix @ x
        rest[0] = 0
        gain = rest[combos].sum(axis=1)
        gain[used] = -1
        best = int(gain.argmax())
        if gain[best] < 1e-9:
            break
        used.append(best)
        matrix, x = np.column_stack([matrix, column(best)]), np.append(x, 0.0)
        while True:
            fit = np.linalg.lstsq(matrix, target, rcond=None)[0]
            if (fit > 1e-12).all():
                x = fit
                break
            low = fit <= 1e-12
            step = np.min(x[low] / np.maximum(x[low] - fit[low], 1e-300))
            x = x + min(1.0, step) * (fit - x)
            keep = x > 1e-12
            if keep.all():
                keep[np.argmin(x)] = False
            used, matrix, x = [k for k, y in zip(used, keep, strict=True) if y], matrix[:, keep], x[keep]
            if not used:
                break
        if not used:
            break
    return sorted(((tuple(int(u) for u in combos[k] if u), float(v)) for k, v in zip(used, x, strict=True)), key=lambda y: -y[1])


def arrange(rests: np.ndarray, window: int, unit: int, plan: list[tuple[tuple[int, ...], float]]) -> list[list[int]]:
    """Sequences as lists of indexes into `rests` (lengths below `window`): the plan's share first, then best fit."""
    waiting: dict[int, list[int]] = {}
    for i in np.argsort(rests, kind="stable").tolist():
        waiting.setdefault(-(-int(rests[i]) // unit), []).append(i)
    sequences = []
    for combo, share in plan:
        times = int(share * len(rests) + 0.5)
        for u in set(combo):
            times = min(times, len(waiting.get(u, ())) // combo.count(u))
        for _ in range(times):
            sequences.append([waiting[u].pop() for u in combo])
    left = sorted((i for some in waiting.values() for i in some), key=lambda i: (-rests[i], i))
    room: list[tuple[int, int]] = []  # (free tokens, sequence), ascending
    for i in left:
        size = int(rests[i])
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            free, k = room.pop(at)
            sequences[k].append(i)
        else:
            free, k = window, len(sequences)
            sequences.append([i])
        if free > size:
            bisect.insort(room, (free - size, k))
    return sequences


def pack(
    encoded: DataFrame, window: int = 2048, unit: int = 8, group_docs: int = 8192, group_tokens: int = 16 << 20, with_ids: bool = False
) -> DataFrame:
    """Pieces of every document with their sequence and offset; `with_ids` adds the piece's ids.

    A task packs groups of at most `group_docs` documents (or one more than `group_tokens` ids hold), in the
    order of its split of the staged table, so a repeated task gives the same pieces.
    """
    if window % unit:
        raise ValueError("unit must divide window")
    units = F.ceil(F.pmod("n_tokens", F.lit(window)) / unit).cast("int")
    histogram = encoded.groupBy(units.alias("units")).count().collect()  # at most window / unit + 1 rows
    counts = np.zeros(window // unit + 1, np.int64)
    for row in histogram:
        counts[row["units"]] = row["count"]
    counts[0] = 0
    plan = solve(counts)

    def group(docs: np.ndarray, sizes: np.ndarray, ids: list[bytes], first: int) -> tuple[list[pa.Array], int]:
        rows, number = [], first  # (document, start, length, sequence, offset)
        whole = sizes // window
        for i in np.flatnonzero(whole).tolist():
            for k in range(int(whole[i])):
                rows.append((i, k * window, window, number, 0))
                number += 1
        rest = sizes - whole * window
        some = np.flatnonzero(rest)
        for members in arrange(rest[some], window, unit, plan):
            at = 0
            for i in some[members].tolist():
                rows.append((i, int(whole[i]) * window, int(rest[i]), number, at))
                at += int(rest[i])
            number += 1
        table = np.array(rows, np.int64).reshape(-1, 5)
        pieces = [ids[i][4 * a : 4 * (a + n)] for i, a, n, _, _ in rows]
        arrays = [
            docs.take(pa.array(table[:, 0])),
            pa.array(table[:, 1]),
            pa.array(table[:, 2]),
            pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
            pa.array(sizes[table[:, 0]]),
            pa.array(table[:, 3]),
            pa.array(table[:, 4]),
        ]
        return arrays + [pa.array(pieces, pa.binary())] * with_ids, number

    names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, tokens, docs = TaskContext.get().partitionId() << 40, [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            t = pa.Table.from_batches(held)
            arrays, number = group(t["doc_id"].combine_chunks(), t["n_tokens"].to_numpy(), t["ids"].to_pylist(), number)
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in common.slices(batches, rows=512):
            held.append(batch)
            docs += batch.num_rows
            tokens += int(np.sum(batch.column("n_tokens").to_numpy(zero_copy_only=False)))
            if docs >= group_docs or tokens >= group_tokens:
                yield flush()
                held, tokens, docs = [], 0, 0
        if held:
            yield flush()

    return encoded.mapInArrow(run, _PIECES + ", ids binary" * with_ids)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all `documents` into sequences of at most 2,048 ids."""
    return pack(encode_documents(common.table(spark, sf_dir, "documents")))


QUERIES = {"op8_packing": op8_packing}
SQL: dict[str, str] = {}
