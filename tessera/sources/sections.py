"""Sections of large line-wise dumps, read by many tasks.

A dump holds one object a line, in sections that begin with a line `"name": [`. Spark's text reader deals byte ranges of one
file to tasks; a line belongs to the range it begins in. Every line gets its place, (start of its range, number in it), which orders the lines of a file.
The marks' places, one row a file, say where a section begins and ends, and each task keeps the lines between them. Nothing reads a file whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LINES = "file string, start long, number long, value string"


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, number, value): every line with the range it was read from and its number there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, next_ = None, 0
        for batch in batches:
            starts = batch["start"].to_numpy()
            files = batch["file"].dictionary_encode()
            codes, names = files.indices.to_numpy(), files.dictionary.to_pylist()
            cuts = np.flatnonzero(np.r_[True, (np.diff(starts) != 0) | (np.diff(codes) != 0)])
            numbers = np.arange(batch.num_rows)
            for at, to in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                here = (names[codes[at]], int(starts[at]))
                begin = next_ if here == last else 0
                numbers[at:to] += begin - at
                last, next_ = here, begin + to - at
            yield pa.RecordBatch.from_arrays([batch["file"], batch["start"], pa.array(numbers.astype(np.int64)), batch["value"]], ["file", "start", "number", "value"])

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    return lines.mapInArrow(run, _LINES)


def section_lines(spark: SparkSession, path: str, section: str, following: str) -> DataFrame:
    """The lines after the first `"section": [` of each file and before the first `"following": [` after it, or the end; a file without the section gives none."""
    lines = placed_lines(spark, path)
    place = F.struct("start", "number")
    mark = lambda name: F.trim("value") == f'"{name}": ['
    opened = lines.where(mark(section)).groupBy("file").agg(F.min(place).alias("begin"))
    closes = lines.where(mark(following)).select("file", place.alias("place"))
    ends = closes.join(opened, "file").where("place > begin").groupBy("file").agg(F.min("place").alias("end"))
    bounds = opened.join(ends, "file", "left")
    # a row for each file of the dump, whose list the driver holds anyway
    inside = lines.join(F.broadcast(bounds), "file").where((place > F.col("begin")) & (F.col("end").isNull() | (place < F.col("end"))))
    return inside.where(~mark(section)).select("file", "start", "number", "value")


def section_objects(spark: SparkSession, path: str, section: str, following: str, schema: str) -> DataFrame:
    """(file, start, number, r, malformed): the section's objects, parsed; `malformed` marks a line that is no such object. Lines that hold only brackets are none."""
    rows = section_lines(spark, path, section, following)
    rows = rows.withColumn("text", F.regexp_replace(F.trim("value"), ",$", "")).where(~F.col("text").isin("", "[", "]", "}", "{"))
    whole = F.from_json("text", f"{schema}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    return rows.withColumn("r", whole).select("file", "start", "number", F.col("r").dropFields("_corrupt").alias("r"), F.col("r._corrupt").isNotNull().alias("malformed"))


def selected_objects(objects: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of objects with a slug that is wanted, lower-cased, the last of each."""
    rows = objects.withColumn("slug", F.lower(F.trim("r.slug"))).join(wanted.select("slug").distinct(), "slug", "left_semi")
    return rows.groupBy("slug").agg(F.max_by("r", F.struct("file", "start", "number")).alias("r"))
