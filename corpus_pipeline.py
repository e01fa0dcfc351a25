"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; what it returns is written
as Parquet and read again as the next one's docs. All but the last return the columns of `documents`.

Defined results of the chain: a null or empty text fails the quality rules and goes; of rows that are equal in id and text one stays, of rows that share an id
with unlike texts each; rows without an id are kept by near_dedup and substring_dedup as they are, and pack like any other; a source that is null is a source of
its own; an empty table gives an empty table at every stage; further columns, whatever they are called, keep their values up to the last stage, which has its own columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, mixing, near, packing, rules, substring


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the policy go."""
    return rules.keep(docs, rules.VERSION)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that are 0.8 similar over runs of five words the document with the smallest id stays."""
    common.bounded_batches(spark)
    return near.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has too are cut out."""
    common.bounded_batches(spark)
    return substring.remove_passages(docs, substring.passages(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, by their source's target weight, in a global random order."""
    return common.beside_others(docs, mixing.mix)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 ids, with their ids as little-endian unsigned 32-bit integers."""
    common.bounded_batches(spark)
    return packing.pack(packing.encode_documents(docs), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: SQL expresses neither the chaining nor the encoding; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
