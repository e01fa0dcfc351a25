"""The source audit against plain integers."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import common, divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, number int, total long"  # clashing names


def brute_force(rows, least=3, top=200):
    docs = defaultdict(lambda: defaultdict(Counter))
    seen = defaultdict(Counter)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        docs[lang or ""][source or ""].update(words)
        seen[lang or ""].update(set(words))
    out = []
    for lang, sources in docs.items():
        kept = sorted((t for t, n in seen[lang].items() if n >= least), key=str.encode)

        def share(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in sources.items()}, share(sum(sources.values(), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if sources[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "mine", 1, 2) for i, r in enumerate(rows)], SCHEMA)


def result(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


ODD = [(None, None, None), (None, "xx", "only"), ("", "en", "a"), ("Été ÉTÉ été A-b C3d\x00e f", "en", "a"), ("été f A b", "en", "b"), ("été A-B c", "en", "b"), ("été " * 5000, "en", None), ("été " * 5000, "en", None),
       ("tie one", "t", "s"), ("tie one", "t", "u"), ("one tie", "t", "v"), ("ß ſ İ K", "t", "é"), ("ß ſ İ K", "t", "z"), ("ß ſ İ K", "t", "Z"), ("a", "none", "p"), ("b", "none", "q")]


def test_equals_brute_force(spark, sf_dir, monkeypatch):
    given = [tuple(r) for r in common.table(spark, sf_dir, "documents").select("text", "lang", "source").collect()]
    want = brute_force(given + ODD)
    assert result(divergence.audit(frame(spark, given + ODD))) == want
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 40)  # several blocks, strips of one group each
    monkeypatch.setattr(divergence, "CELLS", 900)
    assert result(divergence.audit(frame(spark, given + ODD), top=7)) == brute_force(given + ODD, top=7)


def test_empty_table(spark):
    assert divergence.audit(frame(spark, ODD).where("doc_id < 0")).count() == 0


def test_without_kept_terms(spark):
    rows = [("a b", "en", "x"), ("c", "en", "y"), (None, "en", "z")]
    assert result(divergence.audit(frame(spark, rows))) == brute_force(rows)


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_pieces_keep_terms_whole(size):
    text = ("Été, " * 3 + "x" * 50 + " 1 Ab\n" + "é" * 40).encode()
    whole = text.translate(divergence._FOLD).split()
    assert [t for some in divergence.pieces(text, size) for t in some] == whole
    assert list(divergence.pieces(b"", size)) == []


def test_held_counts_are_sent_on(spark, monkeypatch):
    rows = [(f"w{chr(97 + i % 26)} same", "en", f"s{i % 2}") for i in range(60)]
    want = result(divergence.audit(frame(spark, rows)))
    monkeypatch.setattr(divergence, "HELD", 3)
    assert result(divergence.audit(frame(spark, rows))) == want == brute_force(rows)


def test_shares_are_exact():
    rng = np.random.default_rng(0)
    for most in (10, 10**6, 9 * 10**14):
        counts = rng.integers(0, most, 50)
        total, v = int(counts.sum()) // 60 + most, 17
        got = divergence.shares(counts[None, :], np.array([[total]]), v)[0]
        assert got.tolist() == [1 + 10**9 * (int(c) + 1) // (total + v) for c in counts]
    with pytest.raises(OverflowError):
        divergence.shares(np.array([[1]]), np.array([[10**16]]), 1)
