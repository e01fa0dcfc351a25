"""The pipeline's near-duplicates against brute-force Jaccard similarity."""

import itertools
import random

from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import near


def runs(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def kept(rows, similarity=0.8):
    root = {i: i for i, _ in rows}
    sets = {i: runs(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    for _ in rows:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    return {i for i, r in root.items() if i == r}


def test_near_dedup_equals_brute_force_jaccard(spark, sf_dir):
    rnd = random.Random(6)
    rows = []
    for g in range(25):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([40, 150, 400]))]
        for _ in range(rnd.choice([2, 3, 12])):
            copy = base[:]
            for _ in range(rnd.randrange(1 + len(copy) // 35)):
                copy[rnd.randrange(len(copy))] = f"w{rnd.randrange(5000)}"
            rows.append(" ".join(copy))
    rows = list(enumerate([*rows, "", None, "one two", "ONE two", "one three"]))
    docs = spark.createDataFrame([*rows, rows[0], (None, rows[0][1])], "doc_id long, text string")
    got = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, sf_dir).collect()]
    assert sorted(i for i in got if i is not None) == sorted(kept(rows)) and got.count(None) == 1


def test_unlike_texts_of_one_id_are_told_apart(spark, sf_dir):
    text = lambda p: " ".join(f"{p}{i}" for i in range(60))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (2, text("b")), (3, text("b").upper()), (4, text("c")), (4, text("c") + " d e")]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted((r["doc_id"], r["text"][0]) for r in got) == [(1, "a"), (2, "b"), (4, "c")]


def test_similar_pairs_among_many_half_similar_texts(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(near, "NEXT", 1)  # so that most is left to the grid, of small cells
    monkeypatch.setattr(near, "LEFT", 4)
    monkeypatch.setattr(near, "RIGHT", 16)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(300)]

    def changed(words, n):
        words = words[:]
        for at in rnd.sample(range(len(words)), n):
            words[at] = f"x{rnd.randrange(10**6)}"
        return words

    rows = []
    for _ in range(400):
        text = changed(base, 6)
        rows.append(text)
        if rnd.random() < 0.3:
            rows.append(changed(text, 3))
    rnd.shuffle(rows)
    rows = [(i, " ".join(t)) for i, t in enumerate(rows)]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(kept(rows))


def test_grid_finds_every_similar_pair_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(near, "LEFT", 4)
    monkeypatch.setattr(near, "RIGHT", 16)
    rnd = random.Random(9)
    texts = []
    for i in range(60):
        words = [f"w{j}" for j in range(200)]
        for at in rnd.sample(range(200), 1 + i % 5):
            words[at] = f"x{i}"
        texts.append((i, " ".join(words)))
    sets = near._sketches(spark.createDataFrame(texts, "doc_id long, text string")).withColumn("node", F.struct("id", "text_hash"))
    sets = sets.withColumn("name", near._name("node"))
    rows = sets.select("id", "name", "keys").collect()
    none = sets.select("node", F.col("node").alias("root")).limit(0)
    got = {(r["a"], r["b"]) for r in near._across_components(sets, none).collect()}
    shingles = {i: runs(t) for i, t in texts}
    want = set()
    for r, s in itertools.combinations(rows, 2):
        one, two = shingles[r["id"]], shingles[s["id"]]
        if set(r["keys"]) & set(s["keys"]) and len(one & two) >= 0.8 * len(one | two):
            want.add((min(r["name"], s["name"]), max(r["name"], s["name"])))
    assert len(want) > 300 and want <= got


def test_texts_of_a_cell_are_joined_once_and_not_for_every_pair(spark, monkeypatch):
    monkeypatch.setattr(near, "LEFT", 32)
    rnd = random.Random(10)
    texts = []
    for i in range(120):  # 0.7 similar to one another, but for the pairs of the last ten
        words = [f"w{j}" for j in range(300)]
        for at in rnd.sample(range(300), 5):
            words[at] = f"x{i}"
        texts.append(" ".join(words))
    texts = list(enumerate(texts + [t + " y" for t in texts[:10]]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = near._sketches(docs).withColumn("node", F.struct("id", "text_hash"))
    sets = sets.withColumn("name", near._name("node"))
    none = sets.select("node", F.col("node").alias("root")).limit(0)
    moved = []
    slices = near.common.staged
    monkeypatch.setattr(near.common, "staged", lambda df, name, *more: moved.append((name, out := slices(df, name, *more))) or out)
    links = {(r["a"]["id"], r["b"]["id"]) for r in near._links_across(sets, none, near._rows(docs), 0.8).collect()}
    assert {(min(p), max(p)) for p in links} >= {(i, 120 + i) for i in range(10)}
    shingles = {i: runs(t) for i, t in texts}
    assert all(len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]) for a, b in links)
    pairs = near._across_components(sets, none).count()
    assert dict(moved)["hits"].select("of").distinct().count() <= len(texts) < pairs / 5
