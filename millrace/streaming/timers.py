"""Keyed state with event-time timers (S10 on ``transformWithState``).

State lives in RocksDB, outside the heap, and a key costs nothing while no row of it comes and no timer of it fires.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.streaming.core import ACTIVITY, combined_activity

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; a query keeps the provider that it started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def _row(key: str | None, events: int, total: float, last_us: int, expired: bool) -> pd.DataFrame:
    return pd.DataFrame({"key": [key], "events": [events], "total": [total], "last_seen": [pd.Timestamp(last_us, unit="us")], "expired": [expired]})


class Activity(StatefulProcessor):
    """Count and total per key, and the days it was seen on, until it is idle for ``idle_ms``."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # each call to the state is a round trip between the worker and Spark, so that all of a key is one value
        self.kept = handle.getValueState("kept", "events long, total double, last long, timer long, days array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events, total, last, timer, days = self.kept.get() or (0, 0.0, 0, None, [])
        seen = set(days)
        for pdf in rows:
            events += int(pdf["events"].sum())
            total += float(pdf["total"].sum())
            at = pdf["last_seen"].dropna().astype("datetime64[us]").astype("int64")
            last = max(last, int(at.max()) if len(at) else 0)
            seen |= {int(d) for d in (at // 86_400_000_000).unique()}
        # a row that comes late, but within the watermark's delay, may be idle already
        due = max(last // 1000 + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.kept.update((events, total, last, due, sorted(seen)))
        yield _row(key[0], events, total, last, False).assign(days=len(seen))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events, total, last, _, days = self.kept.get()
        self.kept.clear()
        yield _row(key[0], events, total, last, True).assign(days=len(days))

    def close(self) -> None:
        pass


def activity_on_timers(df: DataFrame, key: str, ts: str, value: str, delay: str, idle_minutes: int = 30) -> DataFrame:
    """Running count, total and number of active days per key; a row marked ``expired`` once the watermark is ``idle_minutes`` past its last event.

    Rows are combined per task and day before the shuffle; a row without a time counts, but moves neither days nor timer. A key has one timer, moved with its last event. Start the query within
    ``rocksdb_state`` in output mode update.
    """
    partial = combined_activity(df, key, ts, value).withWatermark("last_seen", delay)
    return partial.groupBy("key").transformWithStateInPandas(Activity(idle_minutes * 60_000), ACTIVITY + ", days long", "Update", "EventTime")
