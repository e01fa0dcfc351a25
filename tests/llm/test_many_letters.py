"""Languages of more letters than a byte can code."""

import random

from tessera.llm import language
from tests.llm.test_models import greedy


def test_languages_of_many_letters():
    rnd = random.Random(4)
    words = lambda first, n: ["".join(chr(first + rnd.randrange(n)) for _ in range(2)) for _ in range(400)]
    vocabulary = {"en": ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(400)], "ja": words(0x4E00, 900), "ko": words(0xAC00, 900), "zh": words(0x4E00, 900)}
    text = lambda lang, n: " ".join(rnd.choices(vocabulary[lang], k=n))
    texts = {lang: [text(lang, 60) for _ in range(20 if lang != "en" else 2)] for lang in vocabulary}
    model = language.fit(texts)
    assert len(model["letters"]) > 1000
    lut = language._code_points(model)
    asked = [lang for lang in vocabulary for _ in range(20)]
    some = [text(lang, 40) for lang in asked]
    count, length = language.phrases(some, model, lut)
    best = (count * model["bits"] / length[:, None]).argmin(axis=1)
    assert [model["langs"][i] for i in best] == asked
    for t, row in list(zip(some, count, strict=True))[::9]:
        want = [greedy(t, " ".join(map(language._clean, texts[lang])), language.BLOCK) for lang in model["langs"]]
        assert row.tolist() == want


def test_many_languages_learn_as_much_and_sparse_tables_agree():
    rnd = random.Random(5)
    texts = {f"l{i}": [" ".join("".join(rnd.choices("abcdefghijklmnop", k=6)) for _ in range(300)) for _ in range(3)] for i in range(12)}
    dense, sparse = language.fit(texts), language.fit(texts, dense_bytes=0)
    alone = language.fit({"l0": texts["l0"]})
    assert dense["bits"][0] == alone["bits"][0] and "dense" in dense["tables"][0] and "dense" not in sparse["tables"][0]
    some = [t[0][100:900] for t in texts.values()]
    a, b = (language.phrases(some, m, language._code_points(m))[0] for m in (dense, sparse))
    assert (a == b).all() and [int(i) for i in (a * dense["bits"]).argmin(axis=1)] == list(range(12))
