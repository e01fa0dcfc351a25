"""The stages keep the values of columns that are called as the operators' own, and languages of long texts only are learnt."""

import random

import corpus_pipeline
from tessera.llm import common, language

#: Names that the stages' modules use inside.
NAMES = ["_id", "_text", "_hash", "_cuts", "_cut_id", "_cut_text", "_left", "_source", "_cdf", "_low", "copies", "copy", "rate", "shuffle_key", "id", "node", "name", "digest", "fp", "keys", "signature", "row", "bits", "words", "text_hash", "a", "b", "further_0", "with space", "do.t"]


def test_values_stay(spark, sf_dir):
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    shared = line(80)
    texts = [f"{line(60)} {shared} {line(30)}" if i % 4 == 0 else line(90) for i in range(24)]
    texts += [texts[1], texts[5] + " more", texts[5]]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 2}", len(t), *(f"{n} of {i}" for n in NAMES)) for i, t in enumerate(texts)], kind)
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
        rows = docs.collect()
        assert docs.columns[5:] == NAMES and rows
        assert all(r[n] == f"{n} of {r['doc_id']}" for r in rows for n in NAMES)
        seen.append(len({r["doc_id"] for r in rows}))
    assert seen[0] == 27 and seen[1] == 24 and any(r["text"] != texts[r["doc_id"]] for r in docs.collect())
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, sf_dir).count() > 0


def test_a_language_of_long_texts(spark):
    rng = random.Random(6)
    text = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(n))
    rows = [(i, text("abcdef", 40), "one") for i in range(60)] + [(100 + i, text("uvwxyz", 4000), "two") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language.sample_texts(docs)
    assert set(sample) == {"one", "two"} and len(sample["two"]) == 1 and len(sample["two"][0]) > 20_000
