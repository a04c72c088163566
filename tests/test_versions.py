"""Versioned tables, incremental models, schema policies, and queries that are watched or run together."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import scratch_path
from millrace.sources import evolution, files
from millrace.sources.versions import ConcurrentWrite, VersionedTable, incremental_model
from millrace.streaming import core as st
from millrace.streaming import lifecycle
from tests.conftest import rows

DAY = datetime(2024, 1, 1)


def events(spark, *data):
    return spark.createDataFrame([(i, DAY + timedelta(hours=h), v) for i, h, v in data], "id int, ts timestamp_ntz, v string")


def test_a_run_killed_before_the_swap_leaves_the_old_table(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    assert table.manifest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.replace(events(spark, (1, 0, "a"))) == 1
    table.write(events(spark, (2, 0, "b")))  # the run ends here
    again = VersionedTable(spark, table.path)
    assert rows(again.read(), "id") == [(1,)] and again.versions() == [1]
    assert again.replace(again.read().unionByName(events(spark, (3, 0, "c")))) == 2  # a table may be read while it is replaced
    assert rows(again.read(), "id") == [(1,), (3,)] and rows(again.read(1), "id") == [(1,)]
    assert len(again.vacuum(keep=1)) == 2
    assert again.versions() == [2] and rows(again.read(), "id") == [(1,), (3,)]


def test_only_one_of_two_writers_commits(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    table.replace(events(spark, (1, 0, "a")))
    one, two = table.write(events(spark, (2, 0, "b"))), table.write(events(spark, (3, 0, "c")))
    assert table.commit(one, 1) == 2
    with pytest.raises(ConcurrentWrite):
        table.commit(two, 1)
    assert rows(table.read(), "id") == [(2,)]


def test_incremental_runs(spark):
    table = VersionedTable(spark, scratch_path(spark, "t"))
    args = ("ts", ["id"], [F.col("ts").desc(), F.col("v")])
    assert incremental_model(table, events(spark, (1, 0, "a"), (2, 5, "b"), (2, 4, "old")), *args) == 1
    assert table.manifest().mark == (DAY + timedelta(hours=5)).isoformat()
    source = events(spark, (1, 0, "changed but old"), (2, 5, "b"), (3, 5, "same instant"), (4, 9, "new"), (5, 2, "late"))
    assert incremental_model(table, source, *args) == 2
    assert rows(table.read(), "id", "v") == [(1, "a"), (2, "b"), (3, "same instant"), (4, "new")]
    assert incremental_model(table, source, *args) is None and table.versions() == [1, 2]  # a rerun
    assert incremental_model(table, source, *args, timedelta(hours=8)) == 3
    assert rows(table.read(), "id") == [(1,), (2,), (3,), (4,), (5,)]
    assert incremental_model(table, source, *args, full_refresh=True) == 4
    assert rows(table.read().where("id = 1"), "v") == [("changed but old",)]
    assert incremental_model(table, source.limit(0), *args) is None
    fresh = VersionedTable(spark, scratch_path(spark, "t"))
    assert incremental_model(fresh, source.limit(0), *args) == 1 and fresh.manifest().mark is None
    assert incremental_model(fresh, source, *args) == 2 and fresh.read().count() == 5


def test_policies_take_over_or_record(spark):
    old, new = T.StructType.fromDDL("a int, b string, c int"), T.StructType.fromDDL("b string, a bigint, d double, c string")
    assert evolution.safe_schema(old, new) == T.StructType.fromDDL("a bigint, b string, c int, d double")
    path, history = scratch_path(spark, "files"), scratch_path(spark, "history")
    spark.createDataFrame([(1, "x", 2)], old).write.parquet(path)
    files.register_table(spark, "watched", path, old)
    more = spark.createDataFrame([("y", 2**40, 0.5)], "b string, a bigint, d double")
    more.write.mode("append").parquet(path)
    logged = evolution.watch_schema(spark, "watched", path, history, "LOG", DAY, more.schema)
    assert spark.table("watched").columns == ["a", "b", "c"] and logged.where("applied").isEmpty()
    evolution.watch_schema(spark, "watched", path, history, "UPDATE", DAY + timedelta(days=1), more.schema)
    assert rows(spark.table("watched"), "a", "b", "c", "d") == [(1, "x", 2, None), (2**40, "y", None, 0.5)]
    seen = evolution.schema_history(spark, history, "watched")
    assert rows(seen.where("applied"), "column", "change") == [("a", "widened"), ("d", "added")]
    assert evolution.schema_history(spark, history, "other").count() == 0
    whole = spark.table("watched").schema
    assert evolution.watch_schema(spark, "watched", path, history, "UPDATE", DAY, whole).isEmpty()
    with pytest.raises(ValueError):
        evolution.watch_schema(spark, "watched", path, history, "IGNORE", DAY, whole)
    spark.range(1).write.saveAsTable("managed_one")
    with pytest.raises(ValueError):
        evolution.watch_schema(spark, "managed_one", path, history, "UPDATE", DAY, whole)
    spark.sql("DROP TABLE watched")
    spark.sql("DROP TABLE managed_one")


def number_stream(spark, n=4):
    path = scratch_path(spark, "numbers")
    spark.range(100).repartition(n).write.parquet(path)
    return spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(path)


def test_the_first_failure_stops_all(spark):
    def fail(df, batch_id):
        raise RuntimeError("sink is gone")

    endless = number_stream(spark)
    started = {}

    def start(name, **options):
        def run():
            started[name] = st.start_query(endless, scratch_path(spark, "offsets"), "append", **options)
            return started[name]
        return run

    slow = start("slow", write=st.append_sink(scratch_path(spark, "sink")), every="1 second")
    with pytest.raises(Exception, match="sink is gone"):
        lifecycle.run_together(spark, {"slow": slow, "failing": start("failing", write=fail)})
    assert not any(q.isActive for q in started.values())
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert lifecycle.run_together(spark, {"slow": slow}, seconds=2)["slow"].exception() is None
    assert not started["slow"].isActive


def test_progress_of_every_batch_is_kept(spark):
    with lifecycle.ProgressLog(spark, scratch_path(spark, "progress"), every=3) as log:
        q = st.start_query(number_stream(spark, 7), scratch_path(spark, "offsets"), "append", fmt="noop", name="numbers")
        q.awaitTermination()
        seen = log.wait(q).where("input_rows > 0")
        assert seen.count() == 7 and seen.agg(F.sum("input_rows")).first()[0] == 100
        report = lifecycle.health_report(seen, slow_ms=-1).first()
        assert (report["query"], report["batches"], report["slow_batches"], report["late_rows"]) == ("numbers", 7, 7, 0)
        assert not math.isnan(report["longest_ms"])
