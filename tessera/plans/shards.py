"""Resumable work by shards: what is finished stays, what is missing is done, and other settings are refused.

Rows fall into shards by a hash of their key. Missing shards are done in waves, each one Spark job whose output is written under a temporary name;
every shard of the wave then gets its own name by one rename. A run that is stopped loses its wave only, and a run over finished shards starts no job.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import compact_name, folded, is_self_name
from tessera.operators.entities import prompt_text

#: What a model gives for a text.
MENTIONS = "array<struct<text:string,label:string,score:float,start:int,end:int>>"


class ManifestChanged(RuntimeError):
    """The folder holds shards of other settings."""


class Shards:
    """Shards under a root folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str, manifest: dict, shards: int):
        self.spark, self.root, self.shards = spark, root.rstrip("/"), shards
        self.manifest = json.loads(json.dumps(manifest | {"shards": shards}, sort_keys=True))
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def check_manifest(self) -> None:
        """Keep the manifest with the first run; raise ManifestChanged where another one is kept."""
        file = f"{self.root}/manifest.json"
        if not self._fs.exists(self._path(file)):
            out = self._fs.create(self._path(file), False)
            out.write(bytearray(json.dumps(self.manifest, indent=2, sort_keys=True).encode()))
            out.close()
            return
        kept = json.loads(self.spark.read.text(file, wholetext=True).first()[0])
        if kept != self.manifest:
            names = sorted(k for k in kept.keys() | self.manifest.keys() if kept.get(k) != self.manifest.get(k))
            raise ManifestChanged(f"{self.root} holds shards of another manifest: {', '.join(names)} differ; choose another folder")

    def finished(self) -> set[int]:
        folder = self._path(f"{self.root}/parts")
        if not self._fs.exists(folder):
            return set()
        return {int(s.getPath().getName().partition("=")[2]) for s in self._fs.listStatus(folder) if s.getPath().getName().startswith("shard=")}

    def run(self, rows: DataFrame, key: str, work: Callable[[DataFrame], DataFrame], wave: int = 64, level: int = 19, done: Callable[[list[int], int], None] = lambda shards, left: None) -> dict[str, int]:
        """Do the missing shards: `work` takes rows and gives rows with the column `shard` kept. `done` is told of each wave. Returns shards written and skipped."""
        self.check_manifest()
        finished = self.finished()
        missing = [n for n in range(self.shards) if n not in finished]
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(self.shards)).cast("int"))
        for at in range(0, len(missing), wave):
            some = missing[at : at + wave]
            temporary = f"{self.root}/_tmp-{uuid.uuid4().hex}"
            try:
                out = work(dealt.where(F.col("shard").isin(some))).hint("rebalance", "shard")  # a large shard is written by several tasks
                out.write.partitionBy("shard").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(temporary)
                self._fs.mkdirs(self._path(f"{self.root}/parts"))
                for n in some:
                    source, target = self._path(f"{temporary}/shard={n}"), self._path(f"{self.root}/parts/shard={n}")
                    if not self._fs.exists(source):  # a shard without rows is finished too
                        self._fs.mkdirs(source)
                    if self._fs.exists(target) or not self._fs.rename(source, target):
                        raise RuntimeError(f"shard {n} was finished by another run")
            finally:
                self._fs.delete(self._path(temporary), True)
            done(some, len(missing) - at - len(some))
        return {"written": len(missing), "skipped": len(finished)}

    def read(self, schema: str) -> DataFrame:
        """The rows of all finished shards."""
        return self.spark.read.schema(f"{schema}, shard int").parquet(f"{self.root}/parts")


def mentions(products: DataFrame, model: Callable[[Column], Column], name: str, own_name: str) -> DataFrame:
    """(shard, slug, entity_text, label, score, start, end, model): what a model finds in products' texts.

    `model` is a column function from a text to MENTIONS, a Pandas UDF for a real one. Mentions of the product itself or of the catalogue go; of those that
    are equal but for case and punctuation the best-scored stays, the first of equals.
    """
    found = products.select("shard", "slug", "name", F.posexplode(model(prompt_text(F.col("tagline"), F.col("description"))).cast(MENTIONS)).alias("i", "e"))
    found = found.where(~F.coalesce(is_self_name(F.col("e.text"), F.col("name")), F.lit(False)) & (compact_name(F.col("e.text")) != own_name))
    rows = found.groupBy("shard", "slug", compact_name(F.col("e.text")).alias("key"), folded(F.col("e.label")).alias("kind")).agg(F.max_by("e", F.struct(F.col("e.score"), -F.col("i"))).alias("e"))
    return rows.select("shard", "slug", F.col("e.text").alias("entity_text"), F.col("e.label").alias("label"), F.col("e.score").alias("score"), F.col("e.start").alias("start"), F.col("e.end").alias("end"), F.lit(name).alias("model"))


MENTION_ROWS = "slug string, entity_text string, label string, score float, start int, end int, model string"
