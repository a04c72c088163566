import pandas as pd
from pyspark.sql import functions as F

from millrace.session import scratch_path
from millrace.streaming import core as st
from millrace.streaming import timers


def test_state_survives_a_restart_and_expires_by_its_timer(spark):
    landed, offsets, path = (scratch_path(spark, n) for n in ("landed", "offsets", "activity"))
    schema = "user long, at timestamp, v double"

    def land(*rows):
        spark.createDataFrame(rows, "user long, at string, v double").withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(landed)
        with timers.rocksdb_state(spark):
            source = spark.readStream.schema(schema).parquet(landed)
            st.start_query(timers.activity_on_timers(source, "user", "at", "v", "10 minutes"), offsets, "update", write=st.append_sink(path)).awaitTermination()

    land((1, "2024-01-01 23:50:00", 1.0), (1, "2024-01-02 00:05:00", 2.0), (2, "2024-01-01 23:55:00", 4.0))
    land((1, "2024-01-02 00:20:00", 8.0), (1, None, 0.5))
    land((3, "2024-01-02 00:40:00", 1.0))
    # 2 expired at a watermark of 00:30 and starts anew; at 01:30 1 and 3 expire
    land((4, "2024-01-02 01:40:00", 1.0), (2, "2024-01-02 01:35:00", 3.0))
    got = sorted((r["key"], r["events"], r["total"], r["days"]) for r in spark.read.parquet(path).where("expired").collect())
    assert got == [("1", 4, 11.5, 2), ("2", 1, 4.0, 1), ("3", 1, 1.0, 1)]
    newest = {r["key"]: (r["events"], r["days"]) for r in spark.read.parquet(path).where("NOT expired").orderBy("last_seen").collect()}
    assert newest["1"] == (4, 2) and newest["4"] == (1, 1)
    assert newest["2"] == (1, 1)


def test_provider_is_set_back(spark):
    before = spark.conf.get(timers.PROVIDER, None)
    with timers.rocksdb_state(spark):
        assert spark.conf.get(timers.PROVIDER) == timers.ROCKS_DB
    assert spark.conf.get(timers.PROVIDER, None) == before


class _State:
    """A state handle that counts the calls to it."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, []

    def getValueState(self, *_):
        return self

    getListState = getValueState

    def __getattr__(self, name):
        raise AssertionError(name)

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):
        return 0


def test_a_key_costs_few_calls_to_the_state_whatever_its_days():
    state, own = _State(), timers.Activity(1000)
    own.init(state)
    for n in (40, 70):
        at = pd.date_range("2024-01-01", periods=n, freq="D")
        state.calls = 0
        (out,) = own.handleInputRows(("a",), iter([pd.DataFrame({"events": 1, "total": 1.0, "last_seen": at})]), state)
        assert out["days"].tolist() == [n] and state.calls <= 4 and len(state.timers) == 1
