"""Event-time streaming operators.

The aggregations take a batch or a streaming DataFrame, so a drained stream can be compared
with the same function on the whole table.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.functions.sums import exact_avg, exact_sum
from millrace.operators.sketches import LG_K
from millrace.operators.upsert import upsert_table


def with_event_time(df: DataFrame, source: Column, delay: str, name: str = "event_time") -> DataFrame:
    """Declare the event time and how late a row may come."""
    return df.withColumn(name, source.cast("timestamp")).withWatermark(name, delay)


def _spread(df: DataFrame, window: Column, keys: Sequence[str | Column], aggs: Sequence[Column]) -> DataFrame:
    out = df.groupBy(window.alias("_w"), *keys).agg(*aggs)
    rest = [c for c in out.columns if c != "_w"]
    return out.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest)


def sales_metrics(sales: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Per window and category: sales, quantity, count, rounded average and largest delay."""
    return _spread(sales.where("amount > 0"), F.window("event_time", width), ["category"], [
        exact_sum("amount").alias("total_sales"), F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.count("transaction_id").alias("transaction_count"), F.round(exact_avg("amount"), 2).alias("avg_transaction_value"),
        F.max("processing_delay_seconds").alias("max_delay_seen")])


def sliding_average(df: DataFrame, ts: str, value: str, size: str, slide: str, keys: Sequence[str] = ()) -> DataFrame:
    return _spread(df, F.window(ts, size, slide), list(keys), [exact_avg(value).alias("avg_value"), F.count(F.lit(1)).alias("rows")])


def hourly_totals(df: DataFrame, ts: str, value: str) -> DataFrame:
    return _spread(df, F.window(ts, "1 hour"), [], [exact_sum(value).alias("total")])


def session_activity(df: DataFrame, ts: str, key: str, value: str, gap: str = "30 minutes") -> DataFrame:
    """Events and value per session of a key; late rows may join two sessions."""
    return _spread(df, F.session_window(ts, gap), [key], [F.count(F.lit(1)).alias("actions"), exact_sum(value).alias("total_value")])


def running_totals(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum and count per key since the start; the state holds one row per key."""
    return df.groupBy(key).agg(exact_sum(value).alias("total"), F.count(F.lit(1)).alias("rows"))


def active_users(df: DataFrame, ts: str, key: str, user: str, width: str = "1 hour", rsd: float = 0.02) -> DataFrame:
    """Approximate distinct users per window and key (exact counts are not possible on streams)."""
    return _spread(df, F.window(ts, width), [key], [F.approx_count_distinct(user, rsd).alias("users")])


def user_sketches(df: DataFrame, ts: str, key: str, user: str, width: str = "1 hour") -> DataFrame:
    """A mergeable sketch of the users per window and key: distinct users of longer spans follow from the stored ones."""
    return _spread(df, F.window(ts, width), [key], [F.hll_sketch_agg(user, LG_K).alias("users_sketch")])


def leaderboard(df: DataFrame, key: str, score: str, n: int = 10) -> DataFrame:
    """Top keys by total score, for output mode complete."""
    return df.groupBy(key).agg(exact_sum(score).alias("total_score")).orderBy(F.col("total_score").desc(), key).limit(n)


def dedup_events(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Each key once; a key is remembered for the watermark delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def match_payments(orders: DataFrame, payments: DataFrame, wait: str = "15 minutes", delay: str = "1 minute") -> DataFrame:
    """Orders (order_id, order_time) joined to payments (payment_order_id, payment_time) that come
    within ``wait``; an order without one comes out as failed once the watermark has passed."""
    o = orders.withWatermark("order_time", delay)
    p = payments.withWatermark("payment_time", delay)
    near = (F.col("order_id") == F.col("payment_order_id")) & (F.col("payment_time") >= F.col("order_time")) & (
        F.col("payment_time") <= F.col("order_time") + F.expr(f"INTERVAL {wait}"))
    return o.join(p, near, "leftOuter").withColumn(
        "status", F.when(F.col("payment_order_id").isNotNull(), "completed").otherwise("failed"))


ACTIVITY = "key string, events long, total double, last_seen timestamp, expired boolean"
_PARTIAL = "key string, events long, total double, last_seen timestamp"


def _combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per key, day and Arrow batch, so a hot key costs few rows in the shuffle."""
    for pdf in batches:
        by = ["key", pdf["at"].dt.floor("D").rename("day")]
        yield pdf.groupby(by, dropna=False).agg(events=("value", "size"), total=("value", "sum"), last_seen=("at", "max")).reset_index("key")


def combined_activity(df: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Partial counts and totals (key, events, total, last_seen) of a stream, combined per task."""
    slim = df.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("at"), F.col(value).cast("double").alias("value"))
    return slim.mapInPandas(_combine, _PARTIAL)


def keyed_activity(df: DataFrame, key: str, ts: str, value: str, delay: str, ttl_minutes: int = 30) -> DataFrame:
    """Running count and total per key, forgotten after ``ttl_minutes`` without events.

    Rows are combined per task before the shuffle, and a key's rows arrive in chunks, so
    neither traffic nor memory follows the rows of one key.
    """

    def row(key_value, events, total, last, expired) -> pd.DataFrame:
        return pd.DataFrame({"key": [key_value], "events": [events], "total": [total],
                             "last_seen": [pd.Timestamp(last, unit="us")], "expired": [expired]})

    def update(group: tuple, chunks, state: GroupState):
        if state.hasTimedOut:
            gone = state.get
            state.remove()
            yield row(group[0], *gone, True)
            return
        events, total, last = state.get if state.exists else (0, 0.0, 0)
        for pdf in chunks:
            events += int(pdf["events"].sum())
            total += float(pdf["total"].sum())
            last = max(last, pdf["last_seen"].max().value // 1000)
        state.update((events, total, last))
        state.setTimeoutTimestamp(max(last // 1000 + ttl_minutes * 60_000, state.getCurrentWatermarkMs() + 1))
        yield row(group[0], events, total, last, False)

    partial = combined_activity(df, key, ts, value).withWatermark("last_seen", delay)
    return partial.groupBy("key").applyInPandasWithState(
        update, ACTIVITY, "events long, total double, last long", "update", GroupStateTimeout.EventTimeTimeout)


# --- running queries ---------------------------------------------------------------------


def check_output_mode(mode: str, aggregated: bool, watermarked: bool, bounded_result: bool = False) -> None:
    """Refuse combinations that Spark rejects late or that let state or output grow without bound."""
    if mode not in ("append", "update", "complete"):
        raise ValueError(f"unknown output mode: {mode}")
    if mode == "append" and aggregated and not watermarked:
        raise ValueError("append needs a watermark when rows are aggregated")
    if mode == "complete" and not aggregated:
        raise ValueError("complete needs an aggregation")
    if mode == "complete" and not bounded_result:
        raise ValueError("complete rewrites the whole result each batch: declare the result as bounded")


def bucket_of(keys: Sequence[str], buckets: int = 16) -> Column:
    """Which part of a keyed table a key lies in, for tables without a date: a batch rewrites only the parts it touches."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def result_shape(df: DataFrame) -> tuple[bool, bool, bool]:
    """Whether the plan aggregates, has a watermark, and limits the number of its rows."""
    plan = df._jdf.queryExecution().analyzed().toString()  # a tilde marks the operators that run on the stream
    return tuple(re.search(rf"^[\s:+|-]*~{node} ", plan, re.M) is not None for node in ("Aggregate", "EventTimeWatermark", "GlobalLimit"))


def start_query(df: DataFrame, checkpoint: str, mode: str = "append", write: Callable[[DataFrame, int], None] | None = None,
                fmt: str | None = None, path: str | None = None, name: str | None = None, every: str | None = None,
                options: Mapping[str, str] | None = None, bounded_result: bool = False) -> StreamingQuery:
    """Start a query with its own checkpoint: ``write`` per batch, or a sink format
    (console, memory, parquet, kafka). An output mode that does not fit the plan is refused
    (``bounded_result`` vouches for a small complete result). Without ``every`` it takes all available input and ends."""
    aggregated, watermarked, bounded = result_shape(df)
    check_output_mode(mode, aggregated, watermarked, bounded or bounded_result)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).options(**(options or {}))
    w = w.trigger(processingTime=every) if every else w.trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    if write is not None:
        return w.foreachBatch(write).start()
    return w.format(fmt).start(path) if path else w.format(fmt).start()


def upsert_sink(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Mapping[str, Column],
                rules: Mapping[str, str] | None = None, processed_at: datetime | None = None, stamp: bool = False) -> Callable[[DataFrame, int], None]:
    """Batch writer into a keyed table; writing a batch twice leaves the same table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns(dict(partition_by))
        if stamp:
            now = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
            rows = rows.withColumns({"batch_id": F.lit(batch_id), "processed_at": now})
        upsert_table(spark, path, rows, keys, list(partition_by), rules)

    return write


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that keeps every row; a replayed batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def retrying(write: Callable[[DataFrame, int], None], dead_letters: str, attempts: int = 3, base_seconds: float = 1.0,
             reraise: bool = True, sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame, int], None]:
    """Try a batch writer several times with 1, 2, 4… second pauses, then park the batch under
    ``dead_letters/batch_id=…`` and fail the query; to go on without it is a decision (``reraise=False``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(attempts):
            try:
                write(batch, batch_id)
                return
            except Exception:
                if attempt + 1 == attempts:
                    batch.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
                    if reraise:
                        raise
                else:
                    sleep(base_seconds * 2 ** attempt)

    return run


def route_sink(routes: Mapping[str, tuple[Column, Callable[[DataFrame, int], None]]]) -> Callable[[DataFrame, int], None]:
    """Batch writer that hands the rows matching each route's condition to the route's writer."""

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for condition, target in routes.values():
                target(kept.where(condition), batch_id)
        finally:
            kept.unpersist()

    return write


PROGRESS = ("query string, batch_id long, input_rows long, rows_per_second double, duration_ms long, slow boolean, "
            "state_rows long, state_bytes long")


def progress_report(spark: SparkSession, query: StreamingQuery, slow_ms: int = 30_000) -> DataFrame:
    """The recent batches of a query; a batch over ``slow_ms`` is marked."""
    rows = []
    for p in query.recentProgress:
        took = p["durationMs"].get("triggerExecution", 0)
        state = p["stateOperators"]
        rows.append((p["name"], p["batchId"], p["numInputRows"], float(p["processedRowsPerSecond"]), took, took > slow_ms,
                     sum(s["numRowsTotal"] for s in state), sum(s["memoryUsedBytes"] for s in state)))
    return spark.createDataFrame(rows, PROGRESS)


def serving_view(batch: DataFrame, speed: DataFrame, ts: str, cutoff: datetime) -> DataFrame:
    """History up to the cutoff and stream results from it on, in one view."""
    at = F.lit(cutoff).cast(batch.schema[ts].dataType)
    return batch.where(F.col(ts) < at).unionByName(speed.where(F.col(ts) >= at))


def stop_all(spark: SparkSession, timeout_seconds: int = 60) -> None:
    """Stop every running query and wait until it has ended."""
    for q in spark.streams.active:
        q.stop()
        q.awaitTermination(timeout_seconds)


def await_any(spark: SparkSession, timeout_seconds: int | None = None) -> None:
    """Wait until one query ends, then stop the others; an error of the ended query is raised."""
    try:
        spark.streams.awaitAnyTermination(timeout_seconds)
    finally:
        stop_all(spark)
