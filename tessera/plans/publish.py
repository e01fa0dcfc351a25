"""Publish the mart: all tables into a new folder, then one pointer that readers follow."""

from __future__ import annotations

import copy
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.dashboard import ordered_list
from tessera.plans.mart import TABLES, Mart

#: Columns that large tables are clustered by, so that readers of one key prune files.
_CLUSTER = {"product_facts": "slug", "product_labels": "slug", "product_entities": "slug", "product_categories": "slug"}
_REPORTS = ("report_top_labels", "report_top_categories", "report_top_domains", "report_label_trends", "report_entity_trends")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def publish(mart: Mart, spark: SparkSession, root: str) -> str:
    """Write every table, then the summary, then move the pointer; a failed build leaves the old mart as it was."""
    name = f"build-{uuid.uuid4().hex}"
    folder = f"{root}/{name}"
    fs, path = _hadoop(spark, folder)
    try:
        mart = copy.copy(mart)
        for table in TABLES:
            rows = getattr(mart, table)
            if key := _CLUSTER.get(table):
                rows = rows.repartitionByRange(key).sortWithinPartitions(key)
            rows.write.option("compression", "zstd").parquet(f"{folder}/{table}")
            vars(mart)[table] = spark.read.parquet(f"{folder}/{table}")  # later tables and the summary read what is written
        summary(mart, spark, folder).write.text(f"{folder}/_summary")
        _point(spark, root, name)
    except Exception:
        fs.delete(path, True)
        raise
    return folder


def _point(spark: SparkSession, root: str, name: str) -> None:
    """Put a new pointer in the old one's place by one rename, so that readers always find one of them."""
    fs, new = _hadoop(spark, f"{root}/next-{name}")
    _, pointer = _hadoop(spark, f"{root}/CURRENT")
    out = fs.create(new)
    out.write(bytearray(name.encode()))
    out.close()
    java = spark.sparkContext._jvm
    over = java.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(over, 1)
    how[0] = over.OVERWRITE
    java.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, pointer, how)


def current(spark: SparkSession, root: str) -> str:
    return f"{root}/{spark.read.text(f'{root}/CURRENT').first()['value']}"


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{current(spark, root)}/{table}")


def summary(mart: Mart, spark: SparkSession, folder: str) -> DataFrame:
    """One row of JSON: metrics, rows of each written table, and the report's lists (each at most 50 rows)."""
    metrics = mart.core_metrics.first().asDict()
    rows = {t: spark.read.parquet(f"{folder}/{t}").count() for t in TABLES}
    lists = {name: [r.asDict() for r in ordered_list(mart, name).limit(50).collect()] for name in _REPORTS}
    notes = ["launch numbers are an order, not dates", "labels and entities cover the products they were found for"]
    return spark.createDataFrame([(json.dumps({"metrics": metrics, "table_rows": rows, "limitations": notes, **lists}, sort_keys=True, default=str),)], "value string").select(F.col("value"))
