"""Whole licence texts beyond the short ones are known."""

import pytest

from tessera.llm import licences


@pytest.mark.parametrize("name", ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "CC0-1.0"])
def test_whole_texts(spark, name):
    text = next(t for n, t in licences.known_texts() if n == name and "\n" in t)
    docs = spark.createDataFrame([(1, "Copyright (c) 2020 Someone\n\n" + text.upper()), (2, text + " and more")], "doc_id long, text string")
    got = {(r["doc_id"], r["unit"], r["license"]) for r in licences.scan(docs, licences.known_digests(spark)).collect()}
    assert {g for g in got if g[1] == "text"} == {(1, "text", name)}


def test_many_known_texts_are_joined_by_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "a\nSPDX-License-Identifier: MIT\nb"), (2, "All rights reserved.")], "doc_id long, text string")
    known = licences.known_digests(spark)
    few, many = (sorted(map(tuple, licences.scan(docs, known, most).collect())) for most in (licences.MOST, 3))
    assert few == many and {(r[0], r[1], r[3]) for r in few} == {(1, "line", "MIT"), (2, "line", "all-rights-reserved"), (2, "text", "all-rights-reserved")}
