"""Exports: the catalogue snapshot, the compact archive and file manifests."""

from __future__ import annotations

import io
import json
import tarfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import sql_content_hash

FIELDS = ("slug", "name", "tagline", "description", "website_url", "categories", "product_url")


def snapshot(products: DataFrame, path: str) -> int:
    """Write the seven fields of the fetched products in slug order; returns their number."""
    rows = products.where("status = 'fetched'").select(*FIELDS)
    rows.repartitionByRange("slug").sortWithinPartitions("slug").write.mode("overwrite").option("compression", "zstd").parquet(path)
    return products.sparkSession.read.parquet(path).count()


def restored(current: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows of a snapshot that the catalogue lacks, marked as fetched, with hash and provenance."""
    rows = spark.read.parquet(path).join(current.select("slug"), "slug", "left_anti")
    digest = sql_content_hash([F.col(c) for c in FIELDS if c != "categories"], F.coalesce("categories", F.array().cast("array<string>")))
    return rows.withColumns({"status": F.lit("fetched"), "content_hash": digest, "tagline_source": F.lit("snapshot"), "description_source": F.lit("snapshot")})


def compact_archive(tables: dict[str, tuple[DataFrame, str]], path: str, level: int = 19, most_rows: int = 5_000_000) -> dict[str, int]:
    """Tables as sorted CSVs with schema.json in one reproducible tar.zst on the driver; for catalogues of bounded size.

    tables: name -> (rows, sort column). Refuses tables beyond `most_rows`; larger ones belong into `snapshot`.
    """
    import zstandard

    if not 1 <= level <= 22:
        raise ValueError("level must be 1 to 22")
    counts, members = {}, {}
    for name, (rows, key) in tables.items():
        n = rows.count()
        if n > most_rows:
            raise ValueError(f"{name} has {n} rows, more than {most_rows}")
        frame = rows.orderBy(key).toPandas()
        counts[name], members[f"{name}.csv"] = n, frame.to_csv(index=False, lineterminator="\n").encode()
    members["schema.json"] = json.dumps({name: {"rows": counts[name], "columns": tables[name][0].columns} for name in tables}, sort_keys=True).encode()
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for name in sorted(members):
            info = tarfile.TarInfo(name)  # owner, group and time stay zero
            info.size = len(members[name])
            tar.addfile(info, io.BytesIO(members[name]))
    with open(path, "wb") as f:
        f.write(zstandard.ZstdCompressor(level=level).compress(out.getvalue()))
    return counts


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(name, bytes, sha256) of the files in a folder."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_manifest(expected: DataFrame, found: DataFrame) -> DataFrame:
    """(name, problem): missing, unexpected, of another size or with another hash."""
    e = expected.select(F.col("name"), F.col("bytes").alias("eb"), F.col("sha256").alias("eh"))
    both = e.join(found, "name", "full_outer")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("eh").isNull(), "unexpected").when(F.col("eb") != F.col("bytes"), "size").when(F.col("eh") != F.col("sha256"), "hash")
    return both.select("name", problem.alias("problem")).where("problem is not null")
