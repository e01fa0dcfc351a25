"""Versioned tables: every write is a new Parquet version, published by a pointer that only moves on if nobody
else has moved it. Readers keep the version they began with.

`write` publishes one table; `publish` several at once, by one snapshot that names the folder of every table. Both compare and
set by renaming a folder to the next version's name: of two writers one finds it taken. That is atomic on HDFS and on local disks;
on a store whose rename copies (plain S3) two writers at the very same moment may both believe they won, so give those one writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


#: The folder of snapshots, beside the tables.
_SNAPSHOTS = "_snapshots"


class CursorChanged(RuntimeError):
    """Another writer has published in the meantime."""


class Store:
    """Tables under a root folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _versions(self, table: str) -> list[int]:
        folder = self._path(f"{self.root}/{table}")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def version(self, table: str) -> int:
        """The published version; 0 if there is none."""
        return max(self._versions(table), default=0)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}/v{self.version(table)}")

    def write(self, table: str, rows: DataFrame, expected: int) -> int:
        """Publish a new version after `expected`; raises CursorChanged if that is no longer the latest."""
        if self.version(table) != expected:
            raise CursorChanged(f"{table}: expected version {expected}, found {self.version(table)}")
        temporary = f"{self.root}/{table}/_tmp-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(temporary)
        self._claim(temporary, table, expected + 1)
        return expected + 1

    def _claim(self, temporary: str, table: str, version: int) -> None:
        """Give a finished folder the name of a version; raises CursorChanged if that name is taken."""
        target = f"{self.root}/{table}/v{version}"
        moved = not self._fs.exists(self._path(target)) and self._fs.rename(self._path(temporary), self._path(target))
        inside = f"{target}/{temporary.rpartition('/')[2]}"  # a rename onto a folder moves into it
        if not moved or self._fs.exists(self._path(inside)):
            self._fs.delete(self._path(inside if moved else temporary), True)
            raise CursorChanged(f"{table}: version {version} was published by another writer")

    def snapshot(self) -> int:
        """The latest published snapshot of several tables; 0 if there is none."""
        return self.version(_SNAPSHOTS)

    def folders(self, snapshot: int | None = None) -> dict[str, str]:
        """The folder of every table in a snapshot, the latest if none is given."""
        snapshot = self.snapshot() if snapshot is None else snapshot
        if not snapshot:
            return {}
        text = self.spark.read.text(f"{self.root}/{_SNAPSHOTS}/v{snapshot}", wholetext=True).first()[0]  # a line for each table
        return json.loads(text)

    def tables(self, snapshot: int | None = None) -> dict[str, DataFrame]:
        """Every table of one snapshot: all of them of the same publish, whatever is published meanwhile."""
        return {name: self.spark.read.parquet(f"{self.root}/{folder}") for name, folder in self.folders(snapshot).items()}

    def publish(self, tables: dict[str, DataFrame], expected: int) -> int:
        """Publish new versions of these tables together after snapshot `expected`; the other tables stay as they are.

        Tables are written first and named by one rename last, so readers find all of them new or all of them old; a failure on the way leaves the old snapshot, and
        takes the folders written so far away.
        """
        if self.snapshot() != expected:
            raise CursorChanged(f"expected snapshot {expected}, found {self.snapshot()}")
        folders, mine = self.folders(expected), []
        temporary = f"{self.root}/{_SNAPSHOTS}/_tmp-{uuid.uuid4().hex}"
        try:
            for name, rows in tables.items():
                folders[name] = f"{name}/data-{uuid.uuid4().hex}"
                mine.append(folders[name])
                rows.write.option("compression", "zstd").parquet(f"{self.root}/{folders[name]}")
            out = self._fs.create(self._path(f"{temporary}/tables.json"))
            out.write(bytearray(json.dumps(folders, indent=1).encode()))
            out.close()
            self._claim(temporary, _SNAPSHOTS, expected + 1)
        except Exception:
            for folder in (*(f"{self.root}/{f}" for f in mine), temporary):
                self._fs.delete(self._path(folder), True)
            raise
        return expected + 1
