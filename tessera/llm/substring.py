"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

1. Seeds: the hashes of every text's runs of `k` words, thinned by winnowing: of any `window` runs in a row the
   least is kept, so two texts with `k + window - 1` words in common share a seed. Runs of `_WIDE` words are seeds
   too: where a passage is made of common lines, those across two lines still lead to its own source.
2. Seeds are sorted by range of (hash, document), which splits even the most common ones, and every document that
   holds a seed is matched with the seed's first document. A seed in a third of all documents gives one match
   each, never all pairs.
3. A document's matches with one other document are chained: in both texts the order must be the same, and the
   gaps between matches cost by their length. Best predecessors come from a Fenwick tree of prefix maxima.
4. The document's text and the stretches of its sources around every chain, even of one seed, are fetched and
   aligned: between seeds by edit alignment, beyond the ends by extension while enough words agree. So periods
   that all match a source's first one are still followed as far as both texts repeat it.
5. Aligned stretches of `_STRETCH` words or more that touch form a passage, whatever their sources; it is reported
   if it has `min_words` words or more.

Defined results: null, empty and short texts have no passages; rows without an id are left out; rows sharing an
id are one document, not compared with itself, but each text has its own passages (`text_hash` tells them apart);
extra columns are left out; an empty table gives no rows. Of several documents with a passage the smallest id is
the source, whichever comes first in the table. A text of any length is read as a whole by one task, which takes
some 40 bytes a word for it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

K, WINDOW, MIN_WORDS, MAX_GAP = 5, 4, 45, 32
#: Words and window of the wide seeds; the shortest aligned stretch, in words, that can be part of a passage.
_WIDE, _WIDE_WINDOW, _STRETCH = 16, 12, 12
#: Bytes of a source's text fetched before a chain; twice as many are fetched behind it. A text that shares a single
#: seed with a source can't go on for long with it: such a seed gets less.
_MARGIN, _LONE = 600, 400
#: A chain that is not similar as a whole is cut at gaps of more words than this.
_CLOSE = 8
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_WHOLE = (1 << 31) - 1
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a byte array begin and end."""
    gap = np.ones(len(text) + 2, bool)
    gap[1:-1] = _SPACES[text]
    turn = np.flatnonzero(gap[1:] != gap[:-1])
    return turn[::2], turn[1::2]


def _word_hashes(text: np.ndarray, begins: np.ndarray, ends: np.ndarray, powers: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(begins), np.uint64)
    step = 1 << 18
    for i in range(0, len(begins), step):
        b, e = begins[i : i + step], ends[i : i + step]
        size = e - b
        longest = int(size.max())
        if longest > len(powers[0]):
            powers[0] = np.cumprod(np.full(2 * longest, 0x9E3779B97F4A7C15, np.uint64))
        start = np.cumsum(size) - size
        at = np.arange(int(size.sum())) - np.repeat(start, size)
        values = (text[at + np.repeat(b, size)].astype(np.uint64) + np.uint64(1)) * powers[0][at]
        out[i : i + step] = np.add.reduceat(values, start)
    return _mixed(out)


def winnowed(hashes: np.ndarray, window: int, owner: np.ndarray | None = None) -> np.ndarray:
    """Positions whose hash is least in some `window` hashes in a row: at least one in each such row.

    `owner` tells the sequence of each hash, -1 for none; only rows within one sequence count.
    """
    n = len(hashes)
    if not n or owner is not None and n < window:
        return np.zeros(0, np.int64)
    window = min(window, n)
    least = hashes[: n - window + 1].copy()
    for t in range(1, window):
        np.minimum(least, hashes[t : n - window + 1 + t], out=least)
    if owner is not None:
        least[(owner[: n - window + 1] != owner[window - 1 :]) | (owner[: n - window + 1] < 0)] = 0
    padded = np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)])
    most = padded[:n].copy()
    for t in range(1, window):
        np.maximum(most, padded[t : n + t], out=most)
    at = np.flatnonzero((most == hashes) & (most > 0))
    if not len(at):
        return at
    # where one hash is least again and again, as in periodic texts, one in half a window is enough
    fresh = np.ones(len(at), bool)
    fresh[1:] = hashes[at[1:]] != hashes[at[:-1]]
    if owner is not None:
        fresh[1:] |= owner[at[1:]] != owner[at[:-1]]
    run = np.cumsum(fresh) - 1
    step = (at - at[fresh][run]) // max(1, window // 2)
    keep = fresh.copy()
    keep[1:] |= step[1:] != step[:-1]
    keep[:-1] |= fresh[1:]
    keep[-1] = True
    return at[keep]


_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def _run_hashes(words: np.ndarray, size: int, powers: dict[int, np.ndarray]) -> np.ndarray:
    """Hashes of all runs of `size` word hashes, from prefix sums of a polynomial."""
    n = len(words)
    for base in (_BASE, _INVERSE):
        if base not in powers or len(powers[base]) < n:
            powers[base] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, base, np.uint64))])
    total = np.concatenate([[np.uint64(0)], np.cumsum(words * powers[_BASE][:n])])
    return _mixed((total[size:] - total[:-size]) * powers[_INVERSE][: n - size + 1] + np.uint64(size))


def seeds(documents: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc, pos, off, h): seeds with the word they begin at and its byte offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, run_powers = [np.ones(1, np.uint64)], {}
        for batch in common.slices(batches, size=2 << 20):  # its texts in a row
            docs, raw = batch.column("doc").to_numpy(), batch.column("text").to_pylist()
            text = np.frombuffer(b" ".join(raw).lower(), np.uint8)
            starts = np.cumsum([0, *(len(x) + 1 for x in raw[:-1])])
            begins, ends = word_spans(text)
            if len(begins) < k:
                continue
            owner = np.searchsorted(starts, begins, side="right") - 1
            first, off = np.searchsorted(begins, starts), begins - starts[owner]
            words = _word_hashes(text, begins, ends, powers)
            for size, some in ((k, window), (_WIDE, _WIDE_WINDOW)):
                n = len(begins) - size + 1
                if n < 1:
                    continue
                h = _run_hashes(words, size, run_powers)
                at = winnowed(h, some, np.where(owner[:n] == owner[size - 1 :], owner[:n], -1))
                of = owner[at]
                columns = (docs[of], (at - first[of]).astype(np.int32), off[at].astype(np.int64), h[at].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "pos", "off", "h"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.where("doc is not null and text is not null").mapInArrow(run, "doc long, pos int, off long, h long")


def chain(matches: list[tuple[int, int]], k: int = K, gap_cost: float = 0.25) -> list[list[int]]:
    """Chains of matches (x, y), which are in order, as lists of their indexes; every match is in one chain.

    A chain scores k for each match, less `gap_cost` for each word between matches in either text. The best
    chain that ends before (x, y) is the prefix maximum of score + gap_cost * (x + y) over smaller y.
    """
    levels = sorted({y for _, y in matches})
    tree: list[tuple[float, int]] = [(0.0, -1)] * (len(levels) + 1)
    score, before = [0.0] * len(matches), [-1] * len(matches)
    i = 0
    while i < len(matches):
        j = i
        while j < len(matches) and matches[j][0] == matches[i][0]:
            x, y = matches[j]
            at = bisect_left(levels, y)
            best = (-1e300, -1)
            while at > 0:  # levels below y
                if tree[at][1] >= 0 and tree[at] > best:
                    best = tree[at]
                at -= at & -at
            gain = best[0] - gap_cost * (x + y)
            score[j], before[j] = (k + gain, best[1]) if best[1] >= 0 and gain > 0 else (float(k), -1)
            j += 1
        for m in range(i, j):
            x, y = matches[m]
            at, value = bisect_left(levels, y) + 1, (score[m] + gap_cost * (x + y), m)
            while at < len(tree):
                if tree[at][1] < 0 or tree[at] < value:
                    tree[at] = value
                at += at & -at
        i = j
    used, found = [False] * len(matches), []
    for m in sorted(range(len(matches)), key=lambda m: (-score[m], m)):
        path = []
        while m >= 0 and not used[m]:
            used[m] = True
            path.append(m)
            m = before[m]
        if path:
            found.append(path[::-1])
    return found


def pieces(matches: list[tuple[int, int]], k: int, max_gap: int) -> list[list[tuple[int, int]]]:
    """Chains cut where a gap passes `max_gap` words."""
    out = []
    gap_cost = k / (2 * (max_gap + k))  # no gap that is allowed outweighs a match
    for path in chain(matches, k, gap_cost) if len(matches) > 1 else [[0]]:
        part: list[tuple[int, int]] = []
        for m in path:
            if part and max(matches[m][0] - part[-1][0], matches[m][1] - part[-1][1]) - k > max_gap:
                out.append(part)
                part = []
            part.append(matches[m])
        out.append(part)
    return out


def _same(a: list[bytes], b: list[bytes]) -> int:
    """Words of the longest common subsequence of two short gaps."""
    if len(a) == len(b):
        straight = sum(map(bytes.__eq__, a, b))
        if straight * 2 >= len(a):
            return straight
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def _extend(a: Iterator[bytes], b: Iterator[bytes], miss: int = 2) -> tuple[int, int]:
    """(words, equal words) gained by walking on while matches (+1) and mismatches (-miss) stay near their best."""
    drop = 4 * miss
    score = best = size = equal = 0
    kept = (0, 0)
    for x, y in zip(a, b, strict=False):
        size += 1
        same = x == y
        equal += same
        score += 1 if same else -miss
        if score > best:
            best, kept = score, (size, equal)
        if score < best - drop:
            break
    return kept


def align(a: list[bytes], b: list[bytes], anchors: list[tuple[int, int]], k: int = K, miss: int = 2) -> tuple[int, int, int, int, int]:
    """(a from, a to, b from, b to, equal words) of the alignment through anchors of k equal words each."""
    x, y = anchors[0]
    left, left_same = _extend(reversed(a[max(0, x - y) : x]), reversed(b[max(0, y - x) : y]), miss)
    equal, at, bt = k, x + k, y + k
    for p, q in anchors[1:]:
        if p >= at and q >= bt:
            equal += _same(a[at:p], b[bt:q]) + k
        else:  # overlapping anchors
            equal += max(0, min(p - at, q - bt) + k)
        at, bt = max(at, p + k), max(bt, q + k)
    right, right_same = _extend(iter(a[at : at + len(b) - bt]), iter(b[bt:]), miss)
    return x - left, at + right, y - left, bt + right, equal + left_same + right_same


def stretches(a: list[bytes], b: list[bytes], anchors: list[tuple[int, int]], k: int, similarity: float) -> list[tuple[int, int, int, int, int]]:
    """Similar alignments through the anchors: of all, else of close ones, else of each by what is similar around it."""

    def similar(anchors: list[tuple[int, int]], miss: int) -> tuple[int, int, int, int, int] | None:
        got = align(a, b, anchors, k, miss)
        return got if got[4] >= similarity * max(got[1] - got[0], got[3] - got[2]) else None

    whole = similar(anchors, 2)
    if whole:
        return [whole]
    out, close = [], [[anchors[0]]]
    for m in anchors[1:]:
        if max(m[0] - close[-1][-1][0], m[1] - close[-1][-1][1]) - k > _CLOSE:
            close.append([])
        close[-1].append(m)
    strict = max(2, round(similarity / max(1 - similarity, 0.02)))
    for part in close:
        got = similar(part, 2) if len(close) > 1 else None
        if got:
            out.append(got)
            continue
        end = -1
        for m in part:
            if m[0] + k > end:
                got = similar([m], strict)
                if got:
                    out.append(got)
                    end = got[1]
    return out


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema.names)


_PASSAGE = pa.schema(
    [("doc_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("source_doc_id", pa.int64()), ("source_start_word", pa.int64()), ("source_n_words", pa.int64()), ("equal_words", pa.int64()), ("passage_start", pa.int64()), ("passage_words", pa.int64()), ("text_hash", pa.int64())]
)
_MATCH = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("source", pa.int64()), ("source_at", pa.int64()), ("h", pa.int64()), ("kind", pa.int32())])
_CHAIN = pa.schema(
    [("doc", pa.int64()), ("number", pa.int32()), ("of", pa.int64()), ("off", pa.int64()), ("size", pa.int64()), ("lead", pa.int64()), ("first", pa.int32()), ("parts", pa.list_(pa.int32())), ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32()))]
)


def _matches(all_seeds: DataFrame) -> DataFrame:
    """(doc, pos, off, source, source_pos, source_off): every seed beside its first occurrence, if another document has that.

    Each task links the seeds of its range. Seeds at a task's start may begin in an earlier one: their rows are
    marked, and led to the least of the first occurrences that the tasks tell of their first and last seeds.
    """
    spark = all_seeds.sparkSession

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = now = None  # the task's first seed and the last one so far: (h, doc, at)
        for batch in batches:
            if not batch.num_rows:
                continue
            h, doc, at = (batch.column(c).to_numpy() for c in ("h", "doc", "at"))
            fresh = np.ones(len(h), bool)
            fresh[1:] = h[1:] != h[:-1]
            where = np.maximum.accumulate(np.where(fresh, np.arange(len(h)), 0))
            source, source_at = doc[where], at[where]
            if now and now[0] == h[0]:
                same = where == 0
                source[same], source_at[same] = now[1], now[2]
            begin = begin or (int(h[0]), int(doc[0]), int(at[0]))
            now = (int(h[-1]), int(source[-1]), int(source_at[-1]))
            opened = h == begin[0]
            keep = opened | (doc != source)
            columns = [x[keep] for x in (doc, at, source, source_at, h, opened.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _MATCH.types, strict=True)], _MATCH.names)
        if begin:
            rows = [(0, 0, d, a, h, 2) for h, d, a in (begin, now)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _MATCH.types, strict=True)], _MATCH.names)

    # seeds are made twice, to find the ranges and to deal them out: that is cheaper than a table of them
    packed = all_seeds.select("h", "doc", F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("off")).alias("at"))
    ordered = packed.repartitionByRange(common.partitions(spark), "h", "doc", "at").sortWithinPartitions("h", "doc", "at")
    linked = common.staged(ordered.mapInArrow(link, "doc long, at long, source long, source_at long, h long, kind int"), "matches", numbers=True)
    told: dict[int, set[tuple[int, int]]] = {}
    for r in linked.where("kind = 2").collect():  # two rows a task
        told.setdefault(r["h"], set()).add((r["source"], r["source_at"]))
    several = {h: min(some) for h, some in told.items() if len(some) > 1}
    both = linked.where("kind < 2").select("doc", "at", "source", "source_at", F.when(F.col("kind") == 1, F.col("h")).alias("h"))
    if several:
        long = lambda x: F.lit(x).cast("long")
        least = F.element_at(F.create_map(*(c for h, (d, a) in several.items() for c in (long(h), F.struct(long(d).alias("source"), long(a).alias("at"))))), F.col("h"))
        both = both.withColumn("f", least).select("doc", "at", F.coalesce("f.source", "source").alias("source"), F.coalesce("f.at", "source_at").alias("source_at"))
    both = both.where("doc <> source")
    low = F.lit(0xFFFFFFFF).cast("long")
    places = [(f"{a}pos", f"{a}off", F.col(f"{a}at")) for a in ("", "source_")]
    return both.select("doc", "source", *(F.shiftright(c, 32).cast("int").alias(p) for p, _, c in places), *(c.bitwiseAND(low).alias(o) for _, o, c in places))


def _whole_documents(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of a sorted stream, cut where the first column changes."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if batch.num_rows:
            held.append(tuple(batch.column(c).to_numpy() for c in names))
            if held[-1][0][-1] != held[0][0][0]:
                whole = tuple(np.concatenate(x) for x in zip(*held, strict=True))
                last = int(np.searchsorted(whole[0], whole[0][-1]))
                yield tuple(x[:last] for x in whole)
                held = [tuple(x[last:] for x in whole)]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _chain_rows(batches: Iterator[pa.RecordBatch], k: int, max_gap: int) -> Iterator[tuple]:
    """For each document a row of its own, then one for each stretch of a source that holds its chains."""
    for doc, source, x, y, off in _whole_documents(batches, ("doc", "source", "pos", "source_pos", "source_off")):
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])
        once = fresh.copy()
        once[1:] |= (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        doc, source, x, y, off, fresh = (c[once] for c in (doc, source, x, y, off, fresh))
        step_x, step_y = np.diff(x, prepend=0), np.diff(y, prepend=0)
        rising = fresh | ((step_x > 0) & (step_y > 0))
        cut = fresh | (np.maximum(step_x, step_y) - k > max_gap)
        begins = np.flatnonzero(fresh)
        straight = np.logical_and.reduceat(rising, begins) if len(begins) else rising
        ends = [*begins[1:].tolist(), len(doc)]
        xs, ys, offs, cuts = x.tolist(), y.tolist(), off.tolist(), cut.tolist()
        last, number = None, 0
        for i, j, d, s, plain in zip(begins.tolist(), ends, doc[begins].tolist(), source[begins].tolist(), straight.tolist(), strict=True):
            if d != last:
                yield (d, 0, d, 0, _WHOLE, 0, 0, None, None, None)
                last, number = d, 1
            if j - i == 1:
                at = max(0, offs[i] - _LONE)
                yield (d, number, s, at, offs[i] + _LONE + _MARGIN - at, offs[i] - at, ys[i], [0], [xs[i]], [ys[i]])
                number += 1
                continue
            if plain:  # in order in both texts: the chain is what it is, cut at wide gaps
                heads = [m for m in range(i, j) if cuts[m]]
                parts = [list(zip(xs[a:b], ys[a:b], strict=True)) for a, b in zip(heads, [*heads[1:], j], strict=True)]
            else:
                parts = pieces(list(zip(xs[i:j], ys[i:j], strict=True)), k, max_gap)
            where = dict(zip(ys[i:j], offs[i:j], strict=True))
            spans = sorted((max(0, where[p[0][1]] - _MARGIN), where[p[-1][1]] + 2 * _MARGIN, p) for p in parts)
            held: list[list[tuple[int, int]]] = []
            at = stop = 0
            for begin, end, part in [*spans, (None, None, None)]:
                if held and (begin is None or begin > stop):
                    first = min(p[0][1] for p in held)
                    held.sort()
                    anchors = [(n, a, b) for n, p in enumerate(held) for a, b in p]
                    yield (d, number, s, at, stop - at, where[first] - at, first, *(list(c) for c in zip(*anchors, strict=True)))
                    held, number = [], number + 1
                if begin is not None:
                    at, stop = (min(at, begin), max(stop, end)) if held else (begin, end)
                    held.append(part)


def passages(
    documents: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS, max_gap: int = MAX_GAP, similarity: float = 0.8
) -> DataFrame:
    """Stretches of text that an earlier document (by id) has too, with their place in both.

    passage_start and passage_words give the whole passage that touching stretches form, text_hash the document's text.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_chain_rows(batches, k, max_gap), _CHAIN, 500)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc, group in groupby((r for batch in batches for r in batch.to_pylist()), key=lambda r: r["doc"]):
                own: dict[int, list[bytes]] = {}
                found: dict[int, set[tuple[int, ...]]] = {}
                for r in group:  # the document's own texts come first
                    if r["number"] == 0:
                        own[r["text_hash"]] = r["piece"].lower().split()
                        continue
                    for text, words in own.items():
                        found.setdefault(text, set()).update(_aligned(words, r, k, similarity))
                for text, some in sorted(found.items()):
                    yield from _joined_passages(sorted(some), doc, text, min_words)

        yield from _batches(rows(), _PASSAGE)

    spark = documents.sparkSession
    parts = common.partitions(spark)
    matches = _matches(seeds(documents, k, window))
    kind = "doc long, number int, of long, off long, size long, lead long, first int, parts array<int>, xs array<int>, ys array<int>"
    chains = matches.repartition(parts, "doc").sortWithinPartitions("doc", "source", "pos", "source_pos").mapInArrow(find, kind)
    chains = common.staged(chains, "chains")
    common.drop_staged(matches)
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").cast("binary").alias("text")).where("id is not null and text is not null")
    own_hash = F.when(F.col("number") == 0, F.xxhash64("text")).alias("text_hash")
    cut = F.substring("text", F.col("off").cast("int") + 1, F.col("size").cast("int")).alias("piece")
    fetched = chains.join(texts, F.col("of") == F.col("id")).select("doc", "number", "of", "off", "lead", "first", "parts", "xs", "ys", cut, own_hash)
    fetched = fetched.repartition(parts, "doc").sortWithinPartitions("doc", "number")
    result = ", ".join(f"{name} long" for name in _PASSAGE.names)
    return fetched.mapInArrow(verify, result)


def _aligned(own: list[bytes], row: dict, k: int, similarity: float) -> Iterator[tuple[int, ...]]:
    """(start, words, source, source start, source words, equal words) of a fetched piece's stretches; none where its seeds are not found."""
    other, j = _words(row)
    if other is None:
        return
    shift = j - row["first"]
    end = -1
    for _, some in groupby(zip(row["parts"], row["xs"], row["ys"], strict=True), key=lambda p: p[0]):
        anchors = [(x, y + shift) for _, x, y in some]
        anchors = [(x, y) for x, y in anchors if x + k <= len(own) and 0 <= y and own[x : x + k] == other[y : y + k]]
        if not anchors or anchors[-1][0] + k <= end:  # within a stretch of the same source
            continue
        for af, at, bf, bt, equal in stretches(own, other, anchors, k, similarity):
            if at - af >= _STRETCH:
                end = max(end, at)
                yield (af, at - af, row["of"], bf - shift, bt - bf, equal)


def _words(row: dict) -> tuple[list[bytes] | None, int]:
    """The piece's words and the index of the first seed's first one; a cut word at its start is left out."""
    raw, lead = row["piece"].lower(), row["lead"]
    if not raw[lead : lead + 1].strip() or raw[max(0, lead - 1) : lead].strip():
        return None, 0
    words, at = raw.split(), len(raw[:lead].split())
    drop = int(row["off"] > 0 and at > 0 and bool(raw[:1].strip()))
    return words[drop:], at - drop


def _joined_passages(found: list[tuple[int, ...]], doc: int, text: int, min_words: int) -> Iterator[tuple]:
    """Stretches of one document, in order, that touch or overlap are one passage; short passages are dropped."""
    held: list[tuple[int, ...]] = []
    end = -1
    for f in [*found, None]:
        if held and (f is None or f[0] > end + 2):
            start = held[0][0]
            if end - start >= min_words:
                for h in held:
                    yield (doc, *h, start, end - start, text)
            held, end = [], -1
        if f is not None:
            held.append(f)
            end = max(end, f[0] + f[1])


def remove_passages(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents without their repeated passages, whose source keeps them; texts with nothing left go.

    The column n_chars, where there is one, is set anew for texts that were cut; further columns stay as they are, however they are called.
    """
    return common.beside_others(documents, lambda rows: _without_passages(rows, found))


def _without_passages(documents: DataFrame, found: DataFrame) -> DataFrame:
    spans = found.select("doc_id", "text_hash", "passage_start", "passage_words").distinct().groupBy(F.col("doc_id").alias("_cut_id"), F.col("text_hash").alias("_cut_text"))
    spans = spans.agg(F.collect_list(F.struct("passage_start", "passage_words")).alias("_cuts"))
    spans = common.staged(spans, "cuts")  # the search for passages ends, and its shuffles go, before the documents are shuffled
    names = documents.columns

    def cut(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        for raw, some in zip(texts.to_pylist(), cuts.to_pylist(), strict=True):
            if raw is None or not some:
                out.append(raw)
                continue
            data = raw.encode("utf-8", "surrogatepass")
            begins, _ = word_spans(np.frombuffer(data, np.uint8))
            begins = [*begins.tolist(), len(data)]
            at, kept = 0, []
            for c in sorted(some, key=lambda c: c["passage_start"]):
                start, stop = (begins[min(len(begins) - 1, c["passage_start"] + d)] for d in (0, c["passage_words"]))
                kept.append(data[at:start])
                at = max(at, stop)
            out.append(b"".join([*kept, data[at:]]).decode("utf-8", "replace").strip())
        return pa.array(out, pa.string())

    # one join for all documents; only texts with passages go to Python. Not deterministic: Spark calls it once a row
    call = F.arrow_udf(cut, "string").asNondeterministic()
    joined = documents.join(spans, (F.col("doc_id").cast("long") == F.col("_cut_id")) & (F.xxhash64(F.col("text").cast("string").cast("binary")) == F.col("_cut_text")), "left")
    some = F.col("_cuts").isNotNull()
    joined = joined.withColumn("_left", call(F.when(some, F.col("text").cast("string")), "_cuts")).where(~some | (F.col("_left") != ""))
    new = {"text": F.when(some, F.col("_left")).otherwise(F.col("text"))}
    if "n_chars" in names:
        new["n_chars"] = F.when(some, F.length("_left").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.select(*(new[c].alias(c) if c in new else F.col(c) for c in names))


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated passage of `documents`."""
    return passages(common.table(spark, sf_dir, "documents"))


QUERIES = {"op5_substring": op5_substring}
SQL: dict[str, str] = {}
