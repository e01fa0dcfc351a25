"""SimHash components and repeated passages against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash, substring
from tessera.llm.components import components

NEAR = "doc_id long, text string, fp string, component_id int"  # clashing names


def test_golay_indices_are_shared_within_two_bits():
    low, high, errors, number = simhash.golay_tables()
    assert sorted(set(number.tolist())) == [1, 6]
    sets = [set(e[e >= 0].tolist()) for e in errors]
    patterns = [0, *(1 << a for a in range(23)), *((1 << a) | (1 << b) for a, b in itertools.combinations(range(23), 2))]
    for p in patterns:
        to = int(low[p & 0xFFF] ^ high[p >> 12])
        assert all(any((e ^ p) in sets[s ^ to] for e in sets[s]) for s in range(1 << 11))


def test_keys_are_shared_within_four_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    other = base.copy()
    for i in range(len(base)):
        for b in rng.choice(64, 4, replace=False):
            other[i] ^= np.uint64(1) << np.uint64(b)
    (ka, ia), (kb, ib) = simhash.keys(base), simhash.keys(other)
    for i in range(len(base)):
        assert set(ka[ia == i].tolist()) & set(kb[ib == i].tolist())


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def linked(fps, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, i), (b, j) in itertools.combinations(zip(fps, ids, strict=True), 2):
        if (a ^ b).bit_count() <= 4:
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = rnd.choices(words, k=rnd.choice([30, 150, 400]))
        for _ in range(rnd.choice([1, 2, 8])):
            copy = base[:]
            for _ in range(rnd.choice([0, 0, 1, 2])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append(" ".join(copy))
    rows += [None, "", "  \n\t", "ONE", "one", "a b c", "A B C D", "long " * 70_000, "MiXed ÄÖ case é", "mixed ÄÖ case é"]
    ids = [3 * i + 1 for i in range(len(rows))]
    frame = spark.createDataFrame([*((i, t, "x", 0) for i, t in zip(ids, rows, strict=True)), (ids[0], rows[0], "x", 0), (None, rows[1], "x", 0)], NEAR)
    got = simhash.near_duplicates(frame).collect()
    fps = [fingerprint(t) for t in rows]
    want = linked(fps, ids)
    assert len(got) == len(rows) + 2
    for r in got:
        if r["doc_id"] is not None:
            assert int(r["fingerprint"], 16) == fps[ids.index(r["doc_id"])] and len(r["fingerprint"]) == 16
            assert r["component_id"] == want[r["doc_id"]]


@pytest.mark.parametrize("chunk", [5, 4096])
def test_dense_groups_are_joined_across_chunks(spark, chunk):
    rng = np.random.default_rng(2)
    fps = {0}
    while len(fps) < 150:
        v = 0
        for b in rng.choice(64, 3, replace=False):
            v |= 1 << int(b)
        fps.add(v)
    fps |= {(1 << 63) - 1}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), chunk=chunk)
    roots = {r["node"]: r["root"] for r in components(edges, "a", "b").collect()}
    want = linked(sorted(fps), sorted(fps))
    groups = {}
    for f, root in want.items():
        groups.setdefault(root, set()).add(f - (1 << 64) if f >> 63 else f)
    for members in groups.values():
        assert len({roots.get(m, m) for m in members}) == 1


def test_components(spark):
    rows = [(i, i + 1) for i in range(10, 40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (102, 100), (1000, 40)] + [(500, 501 + i) for i in range(50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 10 for i in [*range(10, 41), 1000]) and all(got[i] == 100 for i in (100, 101, 102)) and all(got[500 + i] == 500 for i in range(51)) and 7 not in got
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_empty_tables(spark):
    empty = spark.createDataFrame([], NEAR)
    assert simhash.near_duplicates(empty).count() == 0 and substring.passages(empty).count() == 0
    assert substring.remove_passages(empty, substring.passages(empty)).count() == 0


def test_chain_equals_quadratic_dynamic_programme():
    rnd = random.Random(3)
    for _ in range(60):
        matches = sorted({(rnd.randrange(40), rnd.randrange(40)) for _ in range(rnd.randrange(1, 25))})
        paths = substring.chain(matches, k=8, gap_cost=0.25)
        assert sorted(m for p in paths for m in p) == list(range(len(matches)))
        best = []
        for x, y in matches:
            best.append(8 + max([0.0, *(s - 0.25 * (x - a + y - b) for s, (a, b) in zip(best, matches, strict=False) if a < x and b < y)]))
        score = lambda p: 8 * len(p) - sum(0.25 * (matches[b][0] - matches[a][0] + matches[b][1] - matches[a][1]) for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert abs(max(map(score, paths)) - max(best)) < 1e-9
        assert all(matches[a][0] < matches[b][0] and matches[a][1] < matches[b][1] for p in paths for a, b in itertools.pairwise(p))


def test_winnowing_leaves_no_gap():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 60, 500).astype(np.uint64)
    at = substring.winnowed(h, 16)
    assert np.diff(at).max() <= 16 and at[0] < 16 and at[-1] >= 500 - 16
    assert substring.winnowed(h[:3], 16).tolist() == [int(h[:3].argmin())] and len(substring.winnowed(h[:0], 16)) == 0
    periodic = substring.winnowed(np.tile(np.array([7, 9, 8], np.uint64), 200), 16)
    assert np.diff(periodic).max() <= 16 and len(periodic) < 100 and len(substring.winnowed(np.full(100, 7, np.uint64), 16)) < 15


def test_passages(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    text = lambda n: [word() for _ in range(n)]
    shared, fuzzy, short = text(60), text(120), text(20)
    edited = fuzzy[:]
    for i in (10, 35, 36, 70):
        edited[i] = word()
    del edited[95]
    docs = {
        1: text(80) + shared + text(30),
        2: text(5) + shared + text(200),
        3: shared,
        4: text(40) + fuzzy + text(40),
        5: text(10) + edited,
        6: text(100) + short + text(100),
        7: text(50) + short + text(50),
        8: text(300),
        9: text(30_000) + shared + text(10),
    }
    rows = [(i, " ".join(w).upper() if i == 2 else "\n ".join(w), 0, "c") for i, w in docs.items()]
    rows += [(10, None, 0, "c"), (11, "", 0, "c"), (None, " ".join(shared), 0, "c"), (8, " ".join(docs[8]), 0, "c"), (12, "the " * 500, 0, "c"), (13, "the " * 700, 0, "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source int, doc string")
    got = {}
    for r in substring.passages(frame).collect():
        got.setdefault(r["doc_id"], []).append((r["source_doc_id"], r["start_word"], r["n_words"], r["source_start_word"]))
    assert got.pop(2) == [(1, 5, 60, 80)] and got.pop(3) == [(1, 0, 60, 80)] and got.pop(9) == [(1, 30_000, 60, 80)]
    ((source, start, n, at),) = got.pop(5)
    assert (source, start, at) == (4, 10, 40) and n == 119
    assert not set(got) - {13}  # one repeated word is no claim either way
    cut = {r["doc_id"]: r for r in substring.remove_passages(frame, substring.passages(frame)).collect() if r["doc_id"] is not None}
    assert cut[2]["text"].split() == [w.upper() for w in docs[2][:5] + docs[2][65:]] and 3 not in cut
    assert cut[1]["text"].split() == docs[1] and cut[8]["text"].split() == docs[8] and 10 in cut and 11 in cut
    assert cut[5]["text"].split() == docs[5][:10] and set(cut[1].asDict()) == set(frame.columns)


def test_fingerprints_keep_every_row(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(docs).collect()}
    some = docs.orderBy(F.length("text")).limit(40).collect()
    assert len(got) == docs.count() and all(got[r["doc_id"]] % (1 << 64) == fingerprint(r["text"]) for r in some)
