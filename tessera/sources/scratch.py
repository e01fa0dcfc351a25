"""Folders for tables that a job writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share; a local session without one gets a folder of its own."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them share")
        root = tempfile.mkdtemp(prefix="tessera-")
    return f"{root}/tessera/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a written table: what is computed of them later sees the same rows in the same files."""
    path = folder(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
