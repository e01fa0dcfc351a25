"""Helpers shared by the training-data operators: table reading, staged tables, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def bounded_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of at most 1,000 rows and about 16 MB, so that tasks stay small."""
    without_old_shuffles(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def without_old_shuffles(spark: SparkSession) -> None:
    """Spark deletes a query's shuffle files when it ends; else they stay until the driver happens to collect garbage."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a local session without one gets a folder of its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
        folder = tempfile.mkdtemp(prefix="tessera-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, numbers: bool = False) -> DataFrame:
    """Write df to a new table in the shared folder and read it back: the lineage ends here.

    `numbers`: its columns are numbers of many different values, which differences keep small.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    without_old_shuffles(spark)
    kind = {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"} if numbers else {}
    df.write.options(**kind).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing will read again."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/tessera/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2048, size: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Regroup batches into ones of about `size` bytes and at most `rows` rows; one long row stays whole."""
    held: list[pa.RecordBatch] = []
    n = full = 0
    for batch in batches:
        step = max(1, min(rows, batch.num_rows if batch.nbytes <= size else batch.num_rows * size // batch.nbytes))
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            if held and (n + part.num_rows > rows or full + part.nbytes > size):
                yield _joined(held)
                held, n, full = [], 0, 0
            held.append(part)
            n, full = n + part.num_rows, full + part.nbytes
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.concat_batches(batches)


#: The columns of `documents`, which operators know by name.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def beside_others(documents: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `work` makes of documents whose further columns go by names that no operator uses meanwhile; it keeps all columns, and they get their names back."""
    names = documents.columns
    plain = [c if c in DOCUMENT else f"further_{i}" for i, c in enumerate(names)]
    return work(documents.toDF(*plain)).select(*plain).toDF(*names)


def held_out(doc_id: Column) -> Column:
    """True for the rows that no model learns from: crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
