"""Streaming counterparts of the batch aggregates: windowed telemetry, job ledger, attempts, lifecycle events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from docloom.functions.assembly import latest_per_key
from docloom.operators import results
from docloom.session import read_or_empty
from docloom.sources import messages
from docloom.streaming.ingest import write_batch


def start_updates(rows: DataFrame, path: str, checkpoint_path: str, interval: str | None = None, run_id: str = "run-0") -> StreamingQuery:
    """Write the changed aggregate rows of every micro-batch under its batch id."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, run_id, batch_id)

    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint_path).foreachBatch(write)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def current_state(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of every aggregate row written by ``start_updates``."""
    return latest_per_key(updates, keys, ["batch_id"]).drop("batch_id", "run_id")


def compact(updates: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Write only the newest version of every row, so that readers of the state need not go through all versions."""
    newest = latest_per_key(updates, keys, ["batch_id"])
    newest.write.mode("overwrite").parquet(path)
    return updates.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Mergeable:
    """An aggregate that may be taken in parts: ``of`` rows, and ``over`` the results for parts of them, in any order."""

    of: Callable[[DataFrame], DataFrame]
    over: Callable[[DataFrame], DataFrame]


#: Receive counts and deliveries of messages; the current ledger row of jobs.
ATTEMPTS = Mergeable(messages.attempts, messages.merge_attempts)
JOBS = Mergeable(results.latest_jobs, results.latest_jobs)


class LiveTable:
    """A live aggregate without state: each micro-batch is aggregated by itself and written under its run and batch.

    Readers merge the parts, so nothing is ever too late, nothing is evicted, and a replayed batch replaces its own part.
    The stream keeps no keys in memory.  What grows is the table, by a row for each key and batch; ``compact`` brings it
    back to a row for each key, as a new generation beside the parts written meanwhile.
    """

    def __init__(self, spark: SparkSession, path: str, aggregate: Mergeable):
        self.spark, self.path, self.aggregate = spark, path, aggregate

    def start(self, rows: DataFrame, checkpoint_path: str, interval: str | None = None, run_id: str = "run-0") -> StreamingQuery:
        def write(batch: DataFrame, batch_id: int) -> None:
            write_batch(self.aggregate.of(batch), f"{self.path}/parts", run_id, batch_id)

        writer = rows.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(write)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def _generation(self) -> int | None:
        return read_or_empty(self.spark, f"{self.path}/contents", f"{_PART}, generation int").agg(F.max("generation")).first()[0]

    def parts(self) -> DataFrame:
        """All rows to be merged: those of the last generation and the parts it does not hold."""
        generation, parts = self._generation(), self.spark.read.parquet(f"{self.path}/parts")
        if generation is None:
            return parts.drop("run_id", "batch_id")
        held = self.spark.read.schema(_PART).parquet(f"{self.path}/contents/generation={generation}")
        fresh = parts.join(held, ["run_id", "batch_id"], "left_anti").drop("run_id", "batch_id")
        return self.spark.read.parquet(f"{self.path}/base/generation={generation}").unionByName(fresh)

    def current(self) -> DataFrame:
        return self.aggregate.over(self.parts())

    def compact(self) -> int:
        """Merge what is there into the next generation; its list of parts is written last and makes it count."""
        last = self._generation()
        number = 0 if last is None else last + 1
        listed = self.spark.read.parquet(f"{self.path}/parts").select("run_id", F.col("batch_id").cast("long").alias("batch_id")).distinct().collect()
        held = self.spark.createDataFrame(listed, _PART)
        parts = self.spark.read.parquet(f"{self.path}/parts").join(held, ["run_id", "batch_id"], "left_semi")
        if last is not None:
            before = self.spark.read.schema(_PART).parquet(f"{self.path}/contents/generation={last}")
            parts = parts.join(before, ["run_id", "batch_id"], "left_anti")
        rows = parts.drop("run_id", "batch_id")
        if last is not None:
            rows = rows.unionByName(self.spark.read.parquet(f"{self.path}/base/generation={last}"))
        self.aggregate.over(rows).write.mode("overwrite").parquet(f"{self.path}/base/generation={number}")
        held.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/contents/generation={number}")
        return number


_PART = "run_id string, batch_id long"


class RunEvents(StreamingQueryListener):
    """Tells ``emit`` of a query's run: ``(event, query id, details)`` for started, batch, idle and terminated.

    Batch details come from the query's own progress: batch id, rows read, milliseconds, and metrics observed on the stream.
    """

    def __init__(self, emit: Callable[[str, str, dict], None]) -> None:
        self.emit = emit

    def onQueryStarted(self, event) -> None:
        self.emit("started", str(event.id), {"at": event.timestamp})

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = {n: r.asDict() for n, r in (progress.observedMetrics or {}).items()}
        self.emit("batch", str(progress.id), {"batch_id": progress.batchId, "rows": progress.numInputRows, "ms": progress.batchDuration, "observed": observed})

    def onQueryIdle(self, event) -> None:
        self.emit("idle", str(event.id), {"at": event.timestamp})

    def onQueryTerminated(self, event) -> None:
        self.emit("terminated", str(event.id), {"error": event.exception})


class IdleEvents(RunEvents):
    """Calls ``emit(query_id, timestamp)`` whenever a query finds nothing to read."""

    def __init__(self, emit: Callable[[str, str], None]) -> None:
        super().__init__(lambda kind, query, details: emit(query, details["at"]) if kind == "idle" else None)
