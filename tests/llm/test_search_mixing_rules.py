"""Top-k, mixing, rules and licences: edge cases, and SQL on the smallest tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import bitsliced, licences, mixing, registry, rules


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    a, b = registry.queries()[name](spark, sf_dir).toPandas(), con.execute(registry.oracle_sql()[name]).df()
    assert sorted(a) == sorted(b)
    columns = sorted(a)
    a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


VECTORS = [(0, [0.5, -0.25, 1.0]), (0, [0.5, -0.25, 1.0]), (0, [9.5, -0.25, 1.0]), (50, [1.0, 1.0, -1.0]), (100, [0.0, 0.0, 0.0]), (1, None), (2, [None, 1.0, 0.0]), (3, [math.nan, 0.0, 0.0]),
           (4, [math.inf, 0.0, 0.0]), (5, [0.5, -0.25, 1.0]), (6, [0.5, -0.25, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 1.0, 1.0]), (9, [-3.7, 2.2, 0.1]), (150, [-0.001, 5.0, 9.0])]


@pytest.mark.parametrize("block_rows", [2, 100])
def test_top_k_equals_brute_force(spark, block_rows):
    rows = spark.createDataFrame([(i, v, 1) for i, v in VECTORS], "vec_id long, embedding array<float>, block int")
    usable = [(i, [math.floor(256 * x) for x in r["embedding"]]) for r in rows.collect() if (i := r["vec_id"]) is not None and r["embedding"] is not None and all(x is not None and math.isfinite(x) for x in r["embedding"])]
    want = Counter()
    for n, (q, w) in enumerate(usable):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, v, strict=False)), i) for m, (i, v) in enumerate(usable) if m != n)
            want.update((q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5]))
    assert Counter(tuple(r) for r in bitsliced.top_k(rows, block_rows=block_rows).collect()) == want


def test_top_k_in_a_grid_with_large_components(spark, monkeypatch):
    numbers = [(i, [float((i * 7919) % 1013) * 1e4, -float(i % 17), 0.25 * i]) for i in range(0, 400, 2)]
    rows = spark.createDataFrame(numbers, "vec_id long, embedding array<double>")
    vectors = bitsliced.common.staged(bitsliced.quantised(rows).select(F.col("vec_id").alias("number"), "vec_id", "v"), "v")
    got = bitsliced.search(bitsliced.build_index(vectors, 9), vectors.where("vec_id % 50 = 0"), 9, 5, query_rows=1).collect()
    whole = {i: [math.floor(256 * x) for x in v] for i, v in numbers}
    want = set()
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_without_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bitsliced.top_k(empty).count() == 0


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, 8) for i, t, s in rows], "doc_id long, text string, source string, copies int, words int")


def test_mixing(spark):
    rows = [(i, "x" * 100, "big") for i in range(4000)] + [(10_000 + i, "y" * 100, "small") for i in range(500)] + [(20_000, None, None), (20_001, "", "empty"), (None, "z", "big")]
    docs = documents(spark, rows)
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0), ("empty", 1.0), ("absent", 0.0)], "source string, weight double")
    out = mixing.mix(docs, weights).toPandas()
    share = out[out.text.notna()].groupby("source").text.apply(lambda t: t.str.len().sum())
    assert 0.9 < share["small"] / share["big"] < 1.1  # equal weights
    assert {"text", "words"} <= set(out) and out.groupby("doc_id").copies.first().max() > 1
    for doc, some in out.groupby("doc_id"):
        assert sorted(some["copy"]) == list(range(some.copies.iloc[0])) and len(some) == some.copies.iloc[0]
    again = mixing.mix(docs, weights).toPandas()
    assert Counter(map(tuple, out[["doc_id", "copy", "shuffle_key"]].fillna(-1).values)) == Counter(map(tuple, again[["doc_id", "copy", "shuffle_key"]].fillna(-1).values))
    # beyond the broadcast bound the result is the same
    rates = mixing.rates(docs, weights)
    wide = mixing.replicate(docs, rates, broadcast_sources=0).toPandas()
    assert sorted(wide.shuffle_key) == sorted(out.shuffle_key)


def test_mixing_of_no_rows(spark):
    assert mixing.mix(documents(spark, [(1, "a", "b")]).where("doc_id > 1")).count() == 0


def repeated(words, window=8):
    seen = Counter(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    return len({j for i in range(len(words) - window + 1) if seen[tuple(words[i : i + window])] > 1 for j in range(i, i + window)})


TEXTS = [None, "", " \t\n", "one", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 100, "l1 w\nl1 w\n\n \nl1 w\nother", "# * $ % & | < > word", "é日本 ÄÖ\x0b\x0cü\r\nz",
         " ".join(f"w{i}" for i in range(500)) + " " + " ".join(f"w{i}" for i in range(100, 120)), "A B! CD EF GH " * 9, "tail " + "w " * 30_000]


def test_rules_equal_brute_force(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, "one", "s"), (None, "one two", "s")]
    book = rules.apply_policy(rules.ledger(documents(spark, rows)), 2).collect()
    assert len(book) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    for r in book:
        text = texts[r["doc_id"]]
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>") and r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeated(words)
        assert r["base_failed"] == (len(words) < 20 or 100 * r["n_repeat_words"] > 30 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_ablations_and_kept_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    book = rules.apply_policy(rules.ledger(docs), 2)
    kept = {r["doc_id"] for r in book.where("kept").collect()}
    whole = rules.keep(docs, 2)
    assert whole.columns == docs.columns and {r["doc_id"] for r in whole.collect()} == kept
    bits = {name: 1 << i for i, (name, _) in enumerate(rules.RULES)}
    fails = [r["fail_bits"] & rules.mask(rules.POLICIES[2]) for r in book.collect()]
    for r in rules.ablations(book, 2).collect():
        b = bits[r["rule"]]
        assert r["failed"] == sum(1 for f in fails if f & b) and r["failed_alone"] == sum(1 for f in fails if f == b)
    assert rules.ledger(docs.where("doc_id < 0")).count() == 0


def test_licences(spark):
    mit = licences.KNOWN[0][1]
    rows = [(1, mit.upper().replace("<YEAR>", "2020").replace("MERCHANTABILITY", "merchantibility"), "s"), (2, "text\nreleased under the  MIT licence!\nmore", "s"), (3, None, "s"), (4, "", "s"),
            (5, "Copyright (c) 2020 someone", "s"), (6, "Released under the MIT License.", "s"), (6, "Released under the MIT License.", "s"), (7, mit + " and more", "s"), (8, "x\n" * 20_000, "s")]
    got = sorted((r["doc_id"], r["unit"], r["line_no"], r["license"]) for r in licences.scan(documents(spark, rows), licences.known_digests(spark)).collect())
    six = [(6, "line", 1, "MIT"), (6, "text", 0, "MIT")]
    assert got == sorted([(1, "text", 0, "MIT"), (2, "line", 2, "MIT"), *six, *six])
    assert licences.scan(documents(spark, rows).where("doc_id < 0"), licences.known_digests(spark)).count() == 0
