"""Incremental ingestion: available files in micro-batches, each merged once into a versioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.merge import fold, merge
from tessera.plans.store import Store


def ingest(spark: SparkSession, source: str, schema: str, store: Store, table: str, key: str, rules: dict[str, str], ordinal: str, checkpoint: str, files: int = 1) -> int:
    """Fold and merge every new file of a folder; returns the table's version.

    A batch's number is kept in the rows it wrote, so a batch that is replayed after a crash changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        version = store.version(table)
        if version and (store.read(table).agg(F.max("batch_id")).first()[0] or -1) >= number:
            return
        new = fold(batch, key, rules, ordinal).withColumn("batch_id", F.lit(number).cast("long"))
        if version:
            new = merge(store.read(table), new, key, rules | {"batch_id": "last_set"})
        store.write(table, new, version)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(source)
    query = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(apply).start()
    query.awaitTermination()
    return store.version(table)
