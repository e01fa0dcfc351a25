"""Near-duplicates of five-word runs at a Jaccard similarity of 0.8, for the pipeline, on top of op4's SimHash.

Texts with equal sets of runs are joined beforehand by a digest. Candidates come from two sides, as each finds what
the other may miss, and every candidate is verified on both whole texts:

- SimHash fingerprints of the sets within four bits, by `simhash.links` and its Golay keys. At a similarity of 0.8
  two fingerprints differ in some ten bits, so this side alone finds the nearest pairs only.
- `BANDS` keys of `ROWS` minimum hashes each: at a similarity of 0.8 all keys differ once in 2,500 pairs. A key's
  sets are put in a random order, other for every key, and each is compared with the `NEXT` before it, so that many
  near copies of one text become one component without all their pairs.
- What that leaves: a key whose sets lie in several components. There every set outside the key's largest component
  is compared with all of the key's sets in other components, by signatures of one byte for each minimum hash, in
  cells of a grid; where `AGREE` of the 100 bytes agree (sets that are 0.8 similar miss that once in 10,000 times) the
  whole texts are compared in the cell, to which a set's text comes once for all its pairs there. So no set of a key is left out, however common the key.

Sorting is by range of (key, order), and cells are small, so that common keys are split.

Defined results: words are lower-cased in A-Z only; null and empty texts link to each other; rows without an id
stay; equal rows stay once; unlike texts that share an id are told apart; a text of any length is read as a whole
by one task; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common, simhash
from tessera.llm.components import components
from tessera.llm.substring import _mixed, _run_hashes, _word_hashes, word_spans

SHINGLE, BANDS, ROWS, NEXT = 5, 20, 5, 4
#: Bytes of two signatures that agree, at least, where the whole texts are compared; sets of a cell's two sides, and runs of its left one.
AGREE, LEFT, RIGHT, RUNS = 64, 512, 8192, 1 << 20


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of five words; of all words, where they are fewer."""
    if not texts:
        return []
    text = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    starts = np.cumsum([0, *(len(x) + 1 for x in texts[:-1])])
    begins, ends = word_spans(text)
    if not len(begins):
        return [np.zeros(0, np.uint64) for _ in texts]
    words = _word_hashes(text, begins, ends, [np.ones(1, np.uint64)])
    first = [*np.searchsorted(begins, starts).tolist(), len(begins)]
    runs = _run_hashes(words, SHINGLE, {}) if len(words) >= SHINGLE else words[:0]
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a : b - SHINGLE + 1]))
        else:
            out.append(_run_hashes(words[a:b], b - a, {}) if b > a else words[:0])
    return out


def _minima(hashes: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The least value of the hashes' upper halves under each multiplier."""
    least = np.full(len(odd), 0xFFFFFFFF, np.uint32)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(upper), 256):
        np.minimum(least, (upper[i : i + 256, None] * odd).min(axis=0), out=least)
    return least


def _fingerprint(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = documents.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).where("id is not null")
    return rows.select("id", F.xxhash64("text").alias("text_hash"), "text")


def _sketches(documents: DataFrame) -> DataFrame:
    """(id, text_hash, digest, fp, keys, signature, size) of every row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        rng = np.random.default_rng(11)
        odd = rng.integers(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
        weight = rng.integers(0, 1 << 62, ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in common.slices(batches, rows=512, size=2 << 20):
            sets = shingle_sets(batch.column("text").to_pylist())
            least = np.array([_minima(h, odd) for h in sets], np.uint64).reshape(len(sets), BANDS, ROWS)
            band = _mixed((least * weight).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64)
            keys = [b if len(h) else b[:0] for b, h in zip(band, sets, strict=True)]
            digests = [xxhash.xxh128_digest(h.tobytes()) for h in sets]
            columns = (batch.column("id"), batch.column("text_hash"), pa.array(digests, pa.binary()), pa.array([_fingerprint(h) for h in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array([m.tobytes() for m in least.reshape(len(sets), -1).astype(np.uint8)], pa.binary()), pa.array([len(h) for h in sets], pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns), ["id", "text_hash", "digest", "fp", "keys", "signature", "size"])

    return _rows(documents).mapInArrow(run, "id long, text_hash long, digest binary, fp long, keys array<long>, signature binary, size long")


def _name(node: str) -> F.Column:
    """A node (id, text_hash) as one number, to sort and join by; the texts tell apart any two that collide."""
    return F.xxhash64(F.col(f"{node}.id"), F.col(f"{node}.text_hash"))


def _by_minima(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of names that are near each other in the order of a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            old = len(key)
            key = np.concatenate([key, batch.column("key").to_numpy()])
            names = np.concatenate([names, batch.column("name").to_numpy()])
            for d in range(1, NEXT + 1):
                at = np.arange(max(old, d), len(key))
                at = at[(key[at] == key[at - d]) & (names[at] != names[at - d])]
                a, b = names[at], names[at - d]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
            key, names = key[-NEXT:], names[-NEXT:]

    keyed = sets.select("name", F.explode("keys").alias("key")).withColumn("order", F.xxhash64("name", "key"))
    keyed = keyed.repartitionByRange(common.partitions(sets.sparkSession), "key", "order").sortWithinPartitions("key", "order")
    return keyed.select("key", "name").mapInArrow(run, "a long, b long")


def _by_fingerprints(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of names: sets of one fingerprint with its least name, least names of fingerprints within four bits."""
    marks = common.staged(sets.groupBy("fp").agg(F.min("name").alias("least")), "marks")
    same = sets.join(marks.select(F.col("fp").alias("f"), "least"), F.col("fp") == F.col("f")).where("name <> least").select(F.col("least").alias("a"), F.col("name").alias("b"))
    ends = [marks.select(F.col("fp").alias(f"f{x}"), F.col("least").alias(f"n{x}")) for x in "ab"]
    near = simhash.links(marks.select("fp")).join(ends[0], F.col("a") == F.col("fa")).join(ends[1], F.col("b") == F.col("fb"))
    return same.union(near.select(F.col("na").alias("a"), F.col("nb").alias("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _similar(one: np.ndarray, two: np.ndarray, similarity: float) -> bool:
    if min(len(one), len(two)) < similarity * max(len(one), len(two)):
        return False
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both >= similarity * (len(one) + len(two) - both)


def _agreeing(batches: Iterator[pa.RecordBatch], similarity: float, values: Callable) -> Iterator[tuple]:
    """(cell, right values, left values, right parts, left parts), place by place: sets of a cell's two sides, of unlike components, whose sizes and signatures agree as similar sets' do."""
    cell, left = None, []
    for batch in batches:
        cells, side, parts, sizes = (batch.column(c).to_numpy() for c in ("cell", "side", "part", "size"))
        marks = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(len(cells), BANDS * ROWS)
        mine = values(batch)
        turn = np.flatnonzero((cells[1:] != cells[:-1]) | (side[1:] != side[:-1])) + 1
        for i, j in zip([0, *turn.tolist()], [*turn.tolist(), len(cells)], strict=True):
            if i == j:
                continue
            if cells[i] != cell:
                cell, left = cells[i], []
            if side[i] == 0:
                left.append((mine[i:j].copy(), parts[i:j], sizes[i:j], marks[i:j].copy()))
                continue
            for some, of, large, theirs in left:
                for at in range(i, j, 64):
                    end = min(at + 64, j)
                    near = (marks[at:end, None, :] == theirs[None, :, :]).sum(axis=2) >= AGREE
                    near &= parts[at:end, None] != of[None, :]
                    near &= np.minimum(sizes[at:end, None], large[None, :]) >= similarity * np.maximum(sizes[at:end, None], large[None, :])
                    x, y = np.nonzero(near)
                    if len(x):
                        yield cell, mine[at + x], some[y], parts[at + x], of[y]


def _cells(sets: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, signature, size, keys, part) of every set, and the sets of keys with several components in the cells of their grids, left sides first."""
    known = roots.select(_name("node").alias("n"), _name("root").alias("root"))
    parts = sets.join(known, F.col("name") == F.col("n"), "left").select("name", "signature", "size", "keys", F.coalesce("root", "name").alias("part"))
    parts = common.staged(parts, "parts")
    sizes = parts.select("part", "size", F.explode("keys").alias("key")).groupBy("key", "part").agg(F.count("*").alias("n"), F.sum("size").alias("runs"))
    sizes = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum("runs").alias("runs"), F.max(F.struct("n", "part", "runs")).alias("main")).where("n > main.n")
    lefts = F.ceil(F.greatest((F.col("n") - F.col("main.n")) / LEFT, (F.col("runs") - F.col("main.runs")) / RUNS))
    grid = sizes.select(F.col("key").alias("k"), F.col("main.part").alias("main"), lefts.alias("lefts"), F.ceil(F.col("n") / RIGHT).alias("rights"))
    cells = parts.select("name", "part", "signature", "size", F.explode("keys").alias("key")).join(common.staged(grid, "grid"), F.col("key") == F.col("k"))
    of_left, of_right = F.pmod(F.xxhash64("name", "key"), "lefts"), F.pmod(F.xxhash64("key", "name"), "rights")
    as_left = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1), lambda r: F.struct(F.xxhash64("key", of_left, r).alias("cell"), F.lit(0).alias("side")))
    as_right = F.transform(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1), lambda x: F.struct(F.xxhash64("key", x, of_right).alias("cell"), F.lit(1).alias("side")))
    cells = cells.select("name", "part", "signature", "size", F.explode(F.when(F.col("part") != F.col("main"), F.concat(as_left, as_right)).otherwise(as_right)).alias("at"))
    cells = cells.select("at.cell", "at.side", "name", "part", "signature", "size")
    return parts, cells.repartition("cell").sortWithinPartitions("cell", "side")


def _across_components(sets: DataFrame, roots: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Pairs (a, b) of names that share a key, not a component, and agree as similar sets do: what the cells compare on whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine, theirs, _, _ in _agreeing(batches, similarity, lambda batch: batch.column("name").to_numpy()):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(mine, theirs)), pa.array(np.maximum(mine, theirs))], ["a", "b"])

    return _cells(sets, roots)[1].mapInArrow(run, "a long, b long").distinct()


def _links_across(sets: DataFrame, roots: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of nodes that share a key, not a component: enough to join what is similar.

    The sets of a cell that have a partner there by signatures come to the cell once more with their texts, so what is
    moved grows with the sets of a cell and not with its pairs. A task leaves out pairs whose components it has joined already.
    """

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for cell, mine, theirs, _, _ in _agreeing(batches, similarity, lambda batch: batch.column("name").to_numpy()):
            for side, names in ((0, np.unique(theirs)), (1, np.unique(mine))):
                found.append(np.stack([np.full(len(names), cell), np.full(len(names), side), names]))
                n += len(names)
            if n > 1 << 14:
                yield flat(found)
                found, n = [], 0
        if found:
            yield flat(found)

    def flat(found: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in np.unique(np.concatenate(found, axis=1), axis=1)], ["c", "s", "of"])

    def with_sets(batch: pa.RecordBatch) -> np.ndarray:
        out = np.empty(batch.num_rows, object)
        out[:] = list(zip(batch.column("id").to_pylist(), batch.column("text_hash").to_pylist(), shingle_sets(batch.column("text").to_pylist()), strict=True))
        return out

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined: dict[int, int] = {}

        def root(part: int) -> int:
            while part in joined:
                part = joined[part]
            return part

        for _, mine, theirs, *parts in _agreeing(common.slices(batches, rows=512, size=2 << 20), similarity, with_sets):
            found = []
            for one, two, p, q in zip(mine, theirs, parts[0].tolist(), parts[1].tolist(), strict=True):
                p, q = root(p), root(q)
                if p != q and _similar(one[2], two[2], similarity):
                    joined[p] = q
                    found.append((one, two))
            if found:
                ends = [pa.StructArray.from_arrays([pa.array([f[e][k] for f in found], pa.int64()) for k in (0, 1)], ["id", "text_hash"]) for e in (0, 1)]
                yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    parts, cells = _cells(sets, roots)
    some = common.staged(cells.mapInArrow(hits, "c long, s long, of long").distinct(), "hits")
    names = some.select("of").distinct()
    texts = rows.withColumn("n", F.xxhash64("id", "text_hash")).join(names, F.col("n") == F.col("of"), "left_semi").dropDuplicates(["id", "text_hash"])
    texts = parts.select("name", "part", "signature", "size").join(texts, F.col("name") == F.col("n")).drop("n")
    cells = some.select(F.col("c").alias("cell"), F.col("s").alias("side"), "of").join(texts, F.col("of") == F.col("name"))
    cells = cells.select("cell", "side", "part", "signature", "size", "id", "text_hash", "text").repartition("cell").sortWithinPartitions("cell", "side")
    kind = "struct<id:bigint,text_hash:bigint>"
    return cells.mapInArrow(links, f"a {kind}, b {kind}")


def _verified(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes whose whole texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, rows=512, size=4 << 20):
            xs, ys = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            place: dict[bytes, int] = {}
            for t in (*xs, *ys):
                place.setdefault(t, len(place))
            sets = shingle_sets(list(place))
            keep = []
            for x, y in zip(xs, ys, strict=True):
                keep.append(_similar(sets[place[x]], sets[place[y]], similarity))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    texts = rows.select(F.struct("id", "text_hash").alias("node"), F.xxhash64("id", "text_hash").alias("name"), "text")
    one, two = (texts.select(F.col("name").alias(f"n{t}"), F.col("node").alias(f"node_{c}"), F.col("text").alias(t)) for t, c in (("x", "a"), ("y", "b")))
    both = pairs.join(two, F.col("b") == F.col("ny")).join(one, F.col("a") == F.col("nx"))
    kind = "struct<id:bigint,text_hash:bigint>"
    return both.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "x", "y").mapInArrow(run, f"a {kind}, b {kind}")


def one_of_each(documents: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Of each component the row with the smallest id (and of that, text); rows without an id stay. Further columns stay as they are, however they are called."""
    return common.beside_others(documents, lambda rows: _one_of_each(rows, similarity))


def _one_of_each(documents: DataFrame, similarity: float) -> DataFrame:
    rows, sketches = _rows(documents), common.staged(_sketches(documents), "sketches")
    sets = sketches.groupBy("digest").agg(F.min(F.struct("id", "text_hash")).alias("node"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("signature").alias("signature"), F.first("size").alias("size"))
    sets = common.staged(sets.withColumn("name", _name("node")), "sets")
    some = sets.where(F.size("keys") > 0)
    pairs = common.staged(_by_minima(some).union(_by_fingerprints(some.select("fp", "name"))).distinct(), "candidates")
    links = common.staged(_verified(pairs, rows, similarity), "near_links")
    roots = common.staged(components(links, "a", "b"), "roots")
    others = common.staged(_links_across(some, roots, rows, similarity), "more_links")
    if not others.isEmpty():
        roots = common.staged(components(links.union(others), "a", "b"), "roots")
    least = roots.where("node <> root").select("node")
    owner = sketches.select("id", "text_hash", "digest").join(sets.select(F.col("digest").alias("d"), "node"), F.col("digest") == F.col("d"))
    gone = least.union(owner.select(F.struct("id", "text_hash").alias("own"), "node").where("own <> node").select("own").distinct())
    gone = common.staged(gone.select(F.col("node.id").alias("_id"), F.col("node.text_hash").alias("_text")), "gone")
    again = sketches.groupBy("id", "text_hash").count().where("count > 1").select(F.col("id").alias("_id"), F.col("text_hash").alias("_text"))
    again = common.staged(again, "again")
    for table in (sketches, sets, pairs, links, others):
        common.drop_staged(table)
    names, here = documents.columns, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    known = documents.where("doc_id is not null").withColumn("_hash", here)
    known = known.join(gone, (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_hash") == F.col("_text")), "left_anti")
    if not again.isEmpty():  # equal rows, which share id and text
        where = (F.col("doc_id").cast("long") == F.col("_id")) & (F.col("_hash") == F.col("_text"))
        known = known.join(again, where, "left_anti").union(known.join(again, where, "left_semi").dropDuplicates(["doc_id", "_hash"]))
    return known.select(*names).union(documents.where("doc_id is null"))
