"""Sessions on a stream: late rows that join two, closing, rows that are too late, replays."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions.sums import exact_sum
from millrace.plans import q_sources
from millrace.session import scratch_path
from millrace.streaming import sessions
from tests.conftest import rows

DAY = datetime(2024, 1, 1)
SCHEMA = "user string, ts timestamp_ntz, value double"


def at(minutes):
    return DAY + timedelta(minutes=minutes)


def batch(spark, *data):
    return spark.createDataFrame([(u, at(m) if m is not None else None, v) for u, m, v in data], SCHEMA)


def test_a_late_row_joins_two_sessions_and_retracts_them(spark):
    kept = sessions.Sessions(spark, scratch_path(spark, "s"), "user", "ts", "value", delay=timedelta(hours=2))
    first = batch(spark, ("a", 0, 1.0), ("a", 50, 2.0), ("b", 10, 5.0), (None, 0, 1.0), ("a", None, 9.0))
    kept.write(first, 0)
    assert rows(kept.current(), "key", "window_start", "window_end", "actions", "total_value") == sorted(
        [("a", at(0), at(30), 1, 1.0), ("a", at(50), at(80), 1, 2.0), ("b", at(10), at(40), 1, 5.0), (None, at(0), at(30), 1, 1.0)],
        key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
    late = batch(spark, ("a", 25, 0.1), ("b", 40, 1.0), (None, 5, 1.0))
    kept.write(late, 1)
    kept.write(late, 1)  # a replay
    kept.write(first, 0)
    changes = kept.changes().where("batch_id = 1")
    assert rows(changes.where("op = '-' AND key = 'a'"), "window_start") == [(at(0),), (at(50),)]
    assert rows(changes.where("op = '+' AND key = 'a'"), "window_start", "window_end", "actions") == [(at(0), at(80), 3)]
    assert rows(changes.where("key = 'b'"), "op", "window_end") == [("+", at(70)), ("-", at(40))]  # a gap of just 30 minutes doesn't part
    twin = first.unionByName(late).where("ts IS NOT NULL AND user IS NOT NULL").withColumn("t", F.col("ts").cast("timestamp")).groupBy(
        F.session_window("t", "30 minutes"), "user").agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total"))
    assert rows(kept.current().where("key IS NOT NULL"), "key", "actions", "total_value") == rows(twin, "user", "n", "total")
    assert rows(kept.current().where("key IS NULL"), "actions") == [(2,)]


def test_sessions_close_behind_the_watermark(spark):
    kept = sessions.Sessions(spark, scratch_path(spark, "s"), "user", "ts", "value", delay=timedelta(minutes=10))
    kept.write(batch(spark, ("a", 0, 1.0), ("b", 20, 1.0)), 0)
    assert kept.closed().count() == 0
    kept.write(batch(spark, ("c", 55, 1.0)), 1)
    assert rows(kept.closed(), "key") == [("a",)] and rows(sessions.shown(kept.open.read()), "key") == [("b",), ("c",)]
    kept.write(batch(spark, ("a", 3, 1.0), ("b", 46, 1.0)), 2)  # the first is late by more than the delay
    assert kept.late_rows() == 1 and rows(kept.current(), "key", "actions") == [("a", 1), ("b", 2), ("c", 1)]
    kept.write(batch(spark), 3)
    assert kept.current().count() == 3


def test_a_batch_passes_the_open_sessions_once(spark, monkeypatch):
    """Random batches without joins or differences of whole sessions; the changes leave what one batch of all rows gives."""
    rng = random.Random(3)
    data = [[(rng.choice("abcde"), rng.randrange(3000), rng.uniform(-9, 9)) for _ in range(60)] for _ in range(3)]
    kept, whole = (sessions.Sessions(spark, scratch_path(spark, "s"), "user", "ts", "value", delay=timedelta(days=30)) for _ in range(2))
    whole.write(batch(spark, *[r for b in data for r in b]), 0)
    for name in ("join", "exceptAll"):
        monkeypatch.setattr(type(spark.range(1)), name, lambda *a, **k: pytest.fail("passes the open sessions again"))
    for i, b in enumerate(data):
        kept.write(batch(spark, *b), i)
    monkeypatch.undo()
    by = ["key", "window_start", "window_end", "actions", "total_value"]
    assert rows(kept.current(), *by) == rows(whole.current(), *by)
    net = kept.changes().groupBy(*by).agg(F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("n"))
    assert rows(net.where("n <> 0"), *by, "n") == [(*r, 1) for r in rows(whole.current(), *by)]
    assert kept.changes().where("op = '-'").count() > 0


def test_totals_are_folded_once(spark, monkeypatch):
    """A session's total is made with it: showing sessions folds nothing, and one row's total is what its fold gives."""
    kept = sessions.Sessions(spark, scratch_path(spark, "s"), "user", "ts", "value", delay=timedelta(days=30))
    odd = [0.1, -0.0, 1e-40, 5e-324, -1e-40, 1e35, -1e35, float("inf"), float("-inf"), float("nan"), None, 2.0**101, 29.27]
    first = batch(spark, *[(f"{i}", i, v) for i, v in enumerate(odd)], ("m", 0, 0.1), ("m", 1, 0.2), ("m", 2, 1e17), ("m", 500, 7.0), ("n", 0, None), ("n", 1, None))
    late = batch(spark, ("0", 10, 0.2), ("1", 900, 3.0), ("10", 15, -0.0))
    kept.write(first, 0)
    kept.write(late, 1)
    twin = first.unionByName(late).withColumn("t", F.col("ts").cast("timestamp")).groupBy(F.session_window("t", "30 minutes"), "user").agg(
        F.col("session_window.start").cast("timestamp_ntz").alias("start"), F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total")).drop("session_window")
    expected = [tuple(map(repr, r)) for r in rows(twin.orderBy("user", "start").select("user", "start", "n", "total"))]
    monkeypatch.setattr(sessions, "fold", lambda *a: pytest.fail("folds again"))
    assert sorted(tuple(map(repr, r)) for r in rows(kept.current(), "key", "window_start", "actions", "total_value")) == sorted(expected)
    net = kept.changes().groupBy("key", "window_start", "actions", F.col("total_value").cast("string")).agg(F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("n"))
    assert net.where("n = 1").count() == len(expected) and net.where("n NOT IN (0, 1)").count() == 0


def test_the_files_of_a_batch_follow_the_rows(t, monkeypatch):
    """One file was one batch and so one task, whatever its rows."""
    paths = {}

    def noted(spark, label):
        paths[label] = scratch_path(spark, label)
        return paths[label]

    monkeypatch.setattr(q_sources, "scratch_path", noted)
    monkeypatch.setattr(q_sources, "FILE_ROWS", t.events.count() // 12, raising=False)
    kept = q_sources._streamed_sessions(t)
    assert len(list(Path(paths["files"]).glob("*.parquet"))) >= 12
    assert rows(kept.changes().select("batch_id").distinct()) == [(0,), (1,), (2,), (3,)]
    assert kept.current().agg(F.sum("actions")).first()[0] == t.events.count()
