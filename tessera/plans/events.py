"""An append-only log of what runs did: events of jobs, counters that Spark observes on the way, and progress of streams.

Every event is one JSON line in a file of its own, written by the driver under a name that sorts by time; the log is read as a table. Counters are
`observe` metrics of the rows that an action passes anyway, so that counting reads nothing twice.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

EVENTS = "timestamp string, event string, run string, name string, elapsed_seconds double, counters map<string,bigint>, error string"


class EventLog:
    """Events of one run in a folder that several runs may share."""

    def __init__(self, spark: SparkSession, folder: str, run: str | None = None):
        self.spark, self.folder, self.run = spark, folder.rstrip("/"), run or uuid.uuid4().hex
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def emit(self, event: str, name: str | None = None, elapsed_seconds: float | None = None, counters: dict[str, int] | None = None, error: str | None = None) -> None:
        now = dt.datetime.now(dt.UTC)
        row = {"timestamp": now.isoformat(), "event": event, "run": self.run, "name": name, "elapsed_seconds": elapsed_seconds, "counters": counters or {}, "error": error}
        out = self._fs.create(self._path(f"{self.folder}/{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex}.json"), False)
        out.write(bytearray((json.dumps(row) + "\n").encode()))
        out.close()

    @contextmanager
    def step(self, name: str) -> Iterator[Step]:
        """step_started and step_finished around a block, with its counters, or step_failed with the error."""
        self.emit("step_started", name)
        began, step = time.monotonic(), Step(self, name)
        try:
            yield step
        except Exception as e:
            self.emit("step_failed", name, time.monotonic() - began, step.counters(False), f"{type(e).__name__}: {e}"[:1000])
            raise
        self.emit("step_finished", name, time.monotonic() - began, step.counters(True))

    def events(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).json(self.folder)

    def listener(self) -> StreamingQueryListener:
        """For `spark.streams.addListener`: starts, batches and ends of streaming queries."""
        log = self

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
                log.emit("stream_started", event.name or str(event.id))

            def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
                p = event.progress
                took = dict(p.durationMs or {}).get("triggerExecution", 0)
                log.emit("stream_progress", p.name or str(p.id), took / 1000, {"batch": p.batchId, "rows": p.numInputRows})

            def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
                pass

            def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
                log.emit("stream_ended", str(event.id), error=event.exception)

        return Listener()


class Step:
    def __init__(self, log: EventLog, name: str):
        self._log, self._name, self._seen, self._set = log, name, [], {}

    def watch(self, rows: DataFrame, /, **counters: Column) -> DataFrame:
        """The rows, with these counters taken when an action of the step passes them; there must be one."""
        seen = Observation(f"{self._name}-{uuid.uuid4().hex}")
        self._seen.append(seen)
        return rows.observe(seen, *(c.cast("long").alias(n) for n, c in counters.items()))

    def count(self, **counters: int) -> None:
        """Add to counters that the step keeps itself."""
        for n, c in counters.items():
            self._set[n] = self._set.get(n, 0) + c

    def progress(self, **counters: int) -> None:
        """An event on the way, say of a wave of shards."""
        self._log.emit("progress", self._name, counters=counters)

    def counters(self, ended: bool) -> dict[str, int]:
        """Counters so far; those that are observed only where the step's actions have ended."""
        found = dict(self._set)
        for seen in self._seen if ended else ():
            for n, c in seen.get.items():
                found[n] = found.get(n, 0) + (c or 0)
        return found


def durations(events: DataFrame) -> DataFrame:
    """(run, name, event, elapsed_seconds, counters) of the steps that ended, one row a step."""
    return events.where("event IN ('step_finished', 'step_failed')").select("run", "name", "event", "elapsed_seconds", "counters")
