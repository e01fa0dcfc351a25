"""Token files and packing against the tokenizers library itself."""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import common, encoding, packing, token_files

ODD = ["", None, " a", "a ", "a  b", "a\t b", "x\x01y", "\n\n", "a\x1cb.\x1c c", "é́ ́a", "a  b", "it's  'twas", "İSTANBUL ΣΑΣ", "  ", "a.\x85b", "A\nb\n\nc",
       "abc " * 50, "\x02", "x" * 3000, "Hello, world! 12 3.5 naïve Ärger.", "don't (stop) #now*** a$$$ ###", "über-all |  pipes | 你好 мир 🙂"]


@pytest.mark.parametrize("name", [encoding.WORD_BPE, encoding.BYTE_BPE])
def test_encoder_equals_library(name, sf_dir):
    tool, plain = encoding.Encoder(encoding.vocabulary_path(name), memo=5000), Tokenizer.from_file(encoding.vocabulary_path(name))
    texts = ODD + pq.read_table(f"{sf_dir}/documents.parquet")["text"].to_pylist()[:120]
    for some in (texts, texts[::-1], texts[:1]):
        ids, starts = tool.encode(pa.array(some, pa.string()))
        for i, t in enumerate(some):
            assert ids[starts[i] : starts[i + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids, repr(t)


def rows_of(spark, texts):
    rows = [(i * 3, t, "clash", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, n_tokens int")  # clashing names


def test_files_round_trip(spark, tmp_path):
    texts = ODD + ["repeated row", "repeated row"]
    docs = rows_of(spark, texts).union(rows_of(spark, texts[:3]))
    path = f"{tmp_path}/t"
    token_files.write_tokens(docs, path, files=3, page_rows=4, row_group_bytes=4096)
    plain = Tokenizer.from_file(encoding.vocabulary_path(encoding.WORD_BPE))
    want = sorted([(i * 3, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in enumerate([*texts])] + [(i * 3, plain.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in enumerate(texts[:3])])
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], list(r["tokens"])) for r in token_files.read_tokens(spark, path).collect())
    assert [(d, ids) for _, d, _, ids in got] == want
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids)
        at += n
    assert [tuple(r) for r in token_files.read_metadata(spark, path).orderBy("start").collect()] == [(d, s, n) for s, d, n, _ in got]
    one = token_files.read_tokens(spark, path, F.col("doc_id") == 9).collect()
    assert [r["start"] for r in one] == [s for s, d, _, _ in got if d == 9]


def test_file_layout(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/t"
    token_files.write_tokens(common.table(spark, sf_dir, "documents"), path, files=2)
    file = next(iter(sorted(p for p in __import__("glob").glob(f"{path}/*.parquet"))))
    meta = pq.read_metadata(file)
    names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    column = meta.row_group(0).column(names["tokens.list.element"])
    assert any("DICTIONARY" in e for e in column.encodings) and column.has_offset_index and column.has_column_index


def test_empty_table(spark, tmp_path):
    empty = rows_of(spark, ["x"]).where("doc_id < 0")
    token_files.write_tokens(empty, f"{tmp_path}/t", files=2)
    assert token_files.read_tokens(spark, f"{tmp_path}/t").count() == 0
    assert packing.pack(packing.encode_documents(empty)).count() == 0


def test_packing_is_exact(spark, sf_dir):
    texts = ODD + ["long " * 9000, "same", "same"]
    extra = common.table(spark, sf_dir, "documents").select((F.col("doc_id") + 1000).alias("doc_id"), "text")
    docs = rows_of(spark, texts).select("doc_id", "text").union(extra)
    pieces = packing.pack(packing.encode_documents(docs), with_ids=True).toPandas()
    plain = Tokenizer.from_file(encoding.vocabulary_path(encoding.BYTE_BPE))
    want = {r["doc_id"]: np.array(plain.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for r in docs.collect()}
    assert set(pieces.doc_id) == set(want)
    for doc, some in pieces.groupby("doc_id"):
        some = some.sort_values("start")
        assert b"".join(some.ids) == want[doc].tobytes() and (some.doc_tokens == len(want[doc])).all()
        assert some.start.tolist() == (np.cumsum(some.length) - some.length).tolist()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in pieces.itertuples())
    for _, some in pieces.groupby("sequence_id"):
        some = some.sort_values("offset")
        assert some.offset.tolist() == (np.cumsum(some.length) - some.length).tolist() and some.length.sum() <= 2048
    assert pieces.length.sum() / (2048 * pieces.sequence_id.nunique()) > 0.95


def test_least_squares_plan():
    counts = np.zeros(9, np.int64)
    counts[[8, 5, 3, 2]] = [4, 10, 14, 4]  # 4 whole, 10 of 5+3, 4 of 3+3+2 less two threes
    plan = dict(packing.solve(counts))
    assert all(sum(c) == 8 for c in plan) and all(v > 0 for v in plan.values())
    total = counts.sum()
    fitted = np.zeros(9)
    for combo, share in plan.items():
        for u in combo:
            fitted[u] += share * total
    assert np.abs(fitted - counts).sum() <= 4
    assert packing.solve(np.zeros(9, np.int64)) == []
