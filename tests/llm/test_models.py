"""Quality and language: held-out accuracy, edge cases, and the models against plain versions."""

import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import common, language, quality


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    per = np.array([3, 1, 4])
    evidence, t = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pairs, _ = quality.marginals(evidence, per, t)
    at, seen = 0, np.zeros((2, 2))
    for n in per.tolist():
        own, total, one, both = evidence[at : at + n], 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(e * v for e, v in zip(own, y, strict=True)) + sum(t[a, b] for a, b in itertools.pairwise(y)))
            total += w
            one += w * np.array(y)
            for a, b in itertools.pairwise(y):
                both[a, b] += w
        np.testing.assert_allclose(good[at : at + n], one / total, rtol=1e-9)
        seen += both / total
        at += n
    np.testing.assert_allclose(pairs, seen, rtol=1e-9)


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = quality.op6_quality(spark, sf_dir).join(common.table(spark, sf_dir, "labels"), "doc_id").where("held_out").toPandas()
    assert len(got) > 40 and (got.predicted == got.quality).mean() > 0.95 and got.score.between(0, 1).all()


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "Plain words of a text.\nMore of it.", 9), (2, None, 9), (3, "", 9), (3, "", 9), (None, "x", 9), (4, "\n" * 3000, 9), (5, "w$$$ " * 40_000, 9)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (2, 1), (4, 0), (5, 0)], "doc_id long, quality int")
    model = quality.fit(*quality.sample_labelled(docs, labels))
    got = quality.classify(docs, model).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3)}) == 1
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    none = quality.classify(docs, quality.fit([], np.array([]))).collect()
    assert {round(r["score"], 9) for r in none} == {0.5}
    assert quality.classify(docs.where("doc_id < 0"), model).count() == 0


def test_long_texts_score_as_short_ones_do():
    rng = np.random.default_rng(3)
    lines = [b"Plain words of a text.", b"", b"$$$ %% |||", b"BUY NOW!!!", b"Plain words of a text.", b"more of it, and more"]
    texts = [b"\n".join(lines[i] for i in rng.integers(0, len(lines), n)) for n in (1, 2, 700, 6000)] + [b"", b"\n", b"x" * 50_000 + b"\ny"]
    model = quality.fit([lines[0], lines[5], lines[2], lines[3] + b"\n" + lines[3]], np.array([1, 1, 0, 0]))
    np.testing.assert_allclose([quality._long_score(t, model) for t in texts], quality.score_texts(texts, model), rtol=1e-7, atol=1e-9)
    np.testing.assert_allclose(quality.score_batch(texts, model), quality.score_texts(texts, model), rtol=1e-7, atol=1e-9)


def test_samples_are_whole_texts_and_bounded(spark):
    rows = [(1, f"text number {i} " * 20, "en") for i in range(50)] + [(1, "same " * 9, "en")] * 80 + [(2, "x " * 200_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2)]
    assert held == [False, False]
    texts, _ = quality.sample_labelled(docs, labels, rows=30)
    assert len(texts) == 30 and {t.decode() for t in texts} <= {t for _, t, _ in rows[:-1]}
    drawn = language.sample_texts(docs, rows=30)["en"]
    assert len(drawn) <= 30 and len(set(drawn)) == len(drawn) and set(drawn) <= {t for _, t, _ in rows[:-1]}


def greedy(text, corpus, block):
    count = 0
    for i in range(0, len(text), block):
        part, at = text[i : i + block], 0
        while at < len(part):
            n, first = 1, at + (part[at] not in corpus)  # a letter that the corpus lacks opens the phrase behind it
            while at + n < len(part) and part[first : at + n + 1] in corpus:
                n += 1
            count, at = count + 1, at + n
    return count


def test_phrases_equal_plain_parse():
    texts = {"en": ["the quick brown fox jumps over the lazy dog and the other foxes"], "de": ["der schnelle braune fuchs springt über den faulen hund"]}
    model = language.fit(texts)
    lut = language._code_points(model)
    some = ["The quick fox!", "über den hund", "zzz 日本 the", "", None, "a" * 5000, "12 34", "the fox\n\n jumps"]
    count, length = language.phrases(some, model, lut)
    for t, row, n in zip(some, count, length, strict=True):
        clean = language._clean(t or "")
        clean = clean if not (t or "").strip(" ").endswith(("!",)) else clean + " "
        assert abs(n - len(clean)) <= 1
        for lang, got in zip(model["langs"], row, strict=True):
            want = greedy(clean, language._clean(texts[lang][0]), language.BLOCK)
            assert got == (want if n else 0)


def test_language_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = language.op10_language(spark, sf_dir).join(common.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got.lang_pred == got.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_language_edges(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en", 1), (2, "der hund und die katze", "de", 1), (3, None, "en", 1), (4, "123 !!", None, 1), (4, "123 !!", None, 1), (6, "", "xx", 1), (7, "the dog " * 50_000, None, 1), (None, "die katze", None, 1)], "doc_id long, text string, lang string, held_out int")
    model = language.fit(language.sample_texts(docs))
    got = language.identify(docs, model).collect()
    assert len(got) == 8
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["lang_pred"])
    assert by[3] == ["und"] and by[4] == ["und", "und"] and by[6] == ["und"]
    assert set(sum(by.values(), [])) <= {"und", *model["langs"]}
    empty = docs.where(F.col("doc_id") < 0)
    assert language.identify(empty, language.fit(language.sample_texts(empty))).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, language.fit({})).collect()} == {"und"}
