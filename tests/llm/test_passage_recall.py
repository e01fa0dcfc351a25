"""Passages that op5 must not miss: lightly edited, made of common lines, and of one repeated line."""

import random

import pytest

from tessera.llm import substring


@pytest.fixture
def words():
    rnd = random.Random(21)
    return rnd, lambda n: ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(n)]


def covered(spark, docs):
    """Words of each document that lie in a reported passage."""
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {i: set() for i in docs}
    for r in substring.passages(frame).collect():
        assert r["equal_words"] >= 0.8 * max(r["n_words"], r["source_n_words"]) and r["source_doc_id"] < r["doc_id"]
        got[r["doc_id"]] |= set(range(r["start_word"], r["start_word"] + r["n_words"]))
    return got


def longest_similar(a, b):
    """Words of the longest stretch of two texts of one length, word by word, that is 0.8 similar (brute force)."""
    same = [x == y for x, y in zip(a, b, strict=True)]
    n = len(same)
    return max((j - i for i in range(n) for j in range(i + 1, n + 1) if same[i] and same[j - 1] and sum(same[i:j]) >= 0.8 * (j - i)), default=0)


def test_edited_passages_against_brute_force(spark, words):
    rnd, text = words
    docs, wanted = {}, []
    for size in (51, 60, 80):
        for share in (0.0, 0.05, 0.1, 0.15, 0.2):
            for _ in range(12):
                passage = text(size)
                edited = passage[:]
                for i in rnd.sample(range(size), int(share * size)):
                    edited[i] = text(1)[0]
                i = len(docs)
                docs[i], docs[1000 + i] = text(30) + passage + text(30), text(20) + edited + text(20)
                if longest_similar(passage, edited) >= substring.MIN_WORDS:
                    wanted.append((1000 + i, share, size))
    got = covered(spark, docs)
    found = [(share, len(got[i] & set(range(20, 20 + size))) >= 0.8 * substring.MIN_WORDS) for i, share, size in wanted]
    assert all(ok for share, ok in found if share <= 0.1)
    assert sum(ok for _, ok in found) >= 0.95 * len(found) and len(found) > 150


@pytest.mark.parametrize("line", [8, 20, 30])
def test_passages_made_of_common_lines(spark, words, line):
    rnd, text = words
    lines = [text(line) for _ in range(40)]
    docs = {i: text(40) + some + text(40) for i, some in enumerate(lines)}  # each line's first document
    wanted = {}
    for t in range(20):
        size = rnd.choice([60, 80, 100])
        passage = sum(rnd.sample(lines, size // line + 2), [])[line // 2 :][:size]
        docs[100 + t], docs[200 + t] = text(25) + passage + text(25), text(10) + passage + text(10)
        wanted[200 + t] = set(range(10, 10 + size))
    got = covered(spark, docs)
    assert all(len(got[i] & span) >= 0.9 * len(span) for i, span in wanted.items())


@pytest.mark.parametrize("line", [1, 5, 10, 15])
def test_repeated_lines(spark, words, line):
    _, text = words
    docs = {}
    for t, size in enumerate((60, 150, 300, 500)):
        periodic = (text(line) * size)[:size]
        docs[t], docs[10 + t] = text(20) + periodic + text(20), text(30) + periodic + text(30)
    got = covered(spark, docs)
    assert all(len(got[10 + t] & set(range(30, 30 + size))) >= 0.95 * size for t, size in enumerate((60, 150, 300, 500)))
    assert not any(got[t] for t in range(4))
