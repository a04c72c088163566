"""Watching and running several queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = ("query string, query_id string, run_id string, batch_id long, triggered_at timestamp, input_rows long, rows_per_second double, "
            "duration_ms long, state_rows long, state_bytes long, late_rows long")


class ProgressLog(StreamingQueryListener):
    """Appends the progress of every batch of every query to a table.

    A query itself keeps its last 100 batches only. Progress is written in files of up to ``every`` batches, and when a query ends;
    at most ``every`` rows wait in the driver. A batch that runs again after a restart has another ``run_id``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._ended: set[str] = set()
        self._failure: Exception | None = None
        self._changed = threading.Condition()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)
        with self._changed:
            self._flush()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        at = p.timestamp.replace("T", " ").replace("Z", "")
        row = (p.name, str(p.id), str(p.runId), p.batchId, at, p.numInputRows, float(p.processedRowsPerSecond), p.durationMs.get("triggerExecution", 0),
               sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state), sum(s.numRowsDroppedByWatermark for s in state))
        with self._changed:
            self._rows.append(row)
            if len(self._rows) >= self.every:
                self._flush()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._flush()
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _flush(self) -> None:
        if not self._rows:
            return
        schema = PROGRESS.replace("triggered_at timestamp", "triggered_at string")
        try:
            rows = self.spark.createDataFrame(self._rows, schema).withColumn("triggered_at", F.col("triggered_at").cast("timestamp"))
            rows.coalesce(1).write.mode("append").parquet(self.path)
            self._rows = []
        except Exception as e:  # a listener's error would be lost: whoever waits gets it
            self._failure = e

    def wait(self, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """The log once all progress of an ended query is in it."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.id} seen")
            if self._failure:
                raise self._failure
        return self.read()

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def health_report(progress: DataFrame, slow_ms: int = 30_000) -> DataFrame:
    """Per query and run: batches, rows, slow batches, longest batch, largest state and rows that came too late."""
    return progress.groupBy("query", "query_id", "run_id").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"), F.count_if(F.col("duration_ms") > slow_ms).alias("slow_batches"),
        F.max("duration_ms").alias("longest_ms"), F.max("state_rows").alias("state_rows"), F.max("state_bytes").alias("state_bytes"),
        F.sum("late_rows").alias("late_rows"))


def run_together(spark: SparkSession, starters: Mapping[str, Callable[[], StreamingQuery]], seconds: float | None = None) -> dict[str, StreamingQuery]:
    """Start queries at the same time, each in a scheduler pool of its name, and wait until all have ended.

    With ``spark.scheduler.mode=FAIR`` the pools share the executors. The first query that fails stops the others, and its error is
    raised; after ``seconds`` the running ones are stopped. Other queries of the session are left alone.
    """
    context, running = spark.sparkContext, {}
    before = context.getLocalProperty("spark.scheduler.pool")
    end = None if seconds is None else time.monotonic() + seconds
    try:
        for name, start in starters.items():
            context.setLocalProperty("spark.scheduler.pool", name)
            running[name] = start()
        while any(q.isActive for q in running.values()):
            if any(q.exception() for q in running.values() if not q.isActive) or end is not None and time.monotonic() > end:
                break
            next(q for q in running.values() if q.isActive).awaitTermination(1)
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)
        for q in running.values():
            if q.isActive:
                q.stop()
    for q in running.values():
        if error := q.exception():
            raise error
    return running
