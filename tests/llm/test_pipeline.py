"""The pipeline's stages, each against a plain version on its own input."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import common, encoding, rules
from tests.llm.test_near import kept
from tests.llm.test_search_mixing_rules import repeated


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage was given and what it returned, as lists of rows."""
    docs, seen = common.table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.staged(stage(spark, docs, sf_dir), name)
        if name != "sequence_packing":
            assert out.columns == docs.columns
        seen[name] = (docs.collect(), out.collect())
        docs = out
    return seen


def test_quality_rules(stages):
    given, got = stages["quality_rules"]
    bits = {name: 1 << i for i, (name, _) in enumerate(rules.RULES)}
    assert rules.mask(rules.POLICIES[rules.VERSION]) == bits["too_few_words"] | bits["repeated_windows"] | bits["many_symbols"] | bits["duplicate_lines"]

    def kept(text):
        words = text.encode().split()
        lines = [x for x in text.split("\n") if x.encode().split()]
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        return len(words) >= 20 and 100 * repeated(words) <= 30 * len(words) and 10 * symbols <= 3 * len(words) and 2 * (len(lines) - len(set(lines))) <= len(lines)

    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in given if kept(r["text"])}


def test_near_dedup(stages):
    given, got = stages["near_dedup"]
    assert {r["doc_id"] for r in got} == kept([(r["doc_id"], r["text"]) for r in given])


def windows(text, n):
    words = text.lower().split()
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def test_substring_dedup(stages):
    given, got = stages["substring_dedup"]
    before, after = {r["doc_id"]: r["text"] for r in given}, {r["doc_id"]: r["text"] for r in got}
    where = defaultdict(set)
    for i, t in before.items():
        for w in windows(t, 12):
            where[w].add(i)
    for i, t in before.items():
        if all(len(where[w]) == 1 for w in windows(t, 12)):
            assert after[i] == t  # nothing shared, nothing cut
        elif i in after:
            rest = iter(t.split())
            assert all(w in rest for w in after[i].split())  # words are only taken out
    left = Counter(w for t in after.values() for w in set(windows(t, 60)))
    assert max(left.values()) == 1
    assert all(r["n_chars"] == len(r["text"]) for r in got if after[r["doc_id"]] != before[r["doc_id"]])


def test_source_mixing(stages):
    given, got = stages["source_mixing"]
    chars = Counter()
    for r in given:
        chars[r["source"]] += len(r["text"])
    total, weight = sum(chars.values()), sum(math.sqrt(c) for c in chars.values())
    want = Counter()
    for r in given:
        rate = round(math.sqrt(chars[r["source"]]) * total / weight / chars[r["source"]], 9)
        u = int(hashlib.md5(f"7:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        p = c = math.exp(-rate)
        n = 0
        while c <= u:
            n += 1
            p *= rate / n
            c += p
        want[r["doc_id"]] = n
    assert Counter(r["doc_id"] for r in got) == +want
    texts = {r["doc_id"]: r["text"] for r in given}
    assert all(texts[r["doc_id"]] == r["text"] for r in got)


def test_sequence_packing(stages):
    given, got = stages["sequence_packing"]
    plain = Tokenizer.from_file(encoding.vocabulary_path(encoding.BYTE_BPE))
    want = Counter()
    for r in given:
        ids = np.array(plain.encode(r["text"], add_special_tokens=False).ids + [1], "<u4").tobytes()
        want[(r["doc_id"], ids)] += 1
    copies = Counter(r["doc_id"] for r in given)
    tokens = Counter()
    sequences = defaultdict(list)
    for r in got:
        tokens[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(ids[4 * r["start"] : 4 * (r["start"] + r["length"])] == bytes(r["ids"]) for (d, ids) in want if d == r["doc_id"])
    assert tokens == Counter({d: len(ids) // 4 * copies[d] for d, ids in want})
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() == len(stages["sequence_packing"][1]) and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_odd_tables(spark, sf_dir):
    kind = "doc_id long, text string, lang string, source string, n_chars long, row string, copies int, bits string"
    good = " ".join(f"word{i}" for i in range(70))
    rows = [(1, good, "en", "a", 9, "r", 5, "b"), (1, good, "en", "a", 9, "r", 5, "b"), (2, None, None, None, None, None, None, None), (3, "", "en", "a", 0, "r", 1, "b"), (None, good + " more", "en", None, 1, "r", 1, "b"),
            (4, "other " + good, "en", "b", 1, "r", 1, "b"), (5, " ".join(f"x{i}" for i in range(60_000)), "en", "b", 1, "r", 1, "b")]
    for some in (rows, []):
        docs = spark.createDataFrame(some, kind)
        for name, stage in corpus_pipeline.STAGES:
            out = common.staged(stage(spark, docs, sf_dir), name)
            if name != "sequence_packing":
                assert out.columns == docs.columns
                docs = out
        assert out.count() > 0 if some else out.count() == 0
