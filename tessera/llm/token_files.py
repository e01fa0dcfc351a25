"""Token-ID files: Parquet list columns with dictionary or delta encoding, small pages and page indexes.

`write_tokens` range-partitions the documents by id, encodes them in id order and writes one Parquet file per
range. Token ids are a list column: a dictionary page with bit-packed indexes while the dictionary holds,
delta packing beyond it (format version 2). Row groups and pages are bounded, and column and offset indexes
let a reader take the ids of a few documents, or the metadata alone, without reading the rest.

Defined results: a null text counts as empty and has the end id alone; repeated rows and repeated ids each
keep a row, ordered by id and then text; a null id comes first; extra columns are left out; an empty table
gives an empty file set that reads back as no rows. A text of any length is encoded whole by one task and is one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common, encoding

_FILE = "doc_id long, part int, part_start long, n_tokens long, tokens array<int>"


def write_tokens(
    documents: DataFrame,
    path: str,
    vocabulary: str = encoding.WORD_BPE,
    end_id: int = 1,
    files: int | None = None,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 512,
    dictionary: bool = True,
) -> None:
    """Encode whole texts and write their ids in ascending doc_id order.

    `part_start` counts the ids of earlier documents of the same file, `part` is the file's place in the order.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, at = encoding.encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in common.slices(batches):
            ids, starts = encoding.with_end(*tool.encode(batch.column("text")), end_id)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(at + starts[:-1]),
                    pa.array(np.diff(starts)),
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32))),
                ],
                ["doc_id", "part", "part_start", "n_tokens", "tokens"],
            )
            at += int(starts[-1])

    files = files or common.partitions(documents.sparkSession)
    (
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, _FILE)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", str(dictionary).lower())
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.dictionary.page.size", 1 << 20)
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and n_tokens of every document; the ids themselves are not read."""
    rows = spark.read.schema(_FILE).parquet(path).select("doc_id", "part", "part_start", "n_tokens")
    return _with_start(rows, rows).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """doc_id, start, n_tokens and tokens; a condition on doc_id is pushed down to row groups and pages."""
    rows = spark.read.schema(_FILE).parquet(path)
    some = rows if where is None else rows.where(where)
    return _with_start(some, rows).select("doc_id", "start", "n_tokens", "tokens")


def _with_start(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """Add the ids before each file, from a table with one row per file; that many rows are broadcast."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = whole.groupBy("part").agg(F.sum("n_tokens").alias("file_tokens"))
    files = files.select("part", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("file_start"))
    return rows.join(F.broadcast(files), "part").withColumn("start", F.col("file_start") + F.col("part_start"))


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = batch.column("tokens")
        offsets, values = tokens.offsets.to_numpy(), tokens.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode `documents`, write the token files and give a digest of what is read back from them."""
    path = common.fresh_path(spark, "tokens")
    write_tokens(common.table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path).mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")


QUERIES = {"op1_token_files": op1_token_files}
SQL: dict[str, str] = {}
