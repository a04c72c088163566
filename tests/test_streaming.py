"""Streams on file sources: late rows, state expiry, restarts, and equality with the batch twin."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import graph, ml
from millrace.sources import generate
from millrace.streaming import core as st
from tests.conftest import rows

T0 = datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp, v double"


class Landing:
    """A folder of JSON batches; each drain is one restart of the query on the same checkpoint."""

    def __init__(self, spark, tmp_path):
        self.spark, self.dir, self.checkpoint, self.n = spark, tmp_path / "in", str(tmp_path / "offsets"), 0
        self.dir.mkdir()

    def put(self, *events):
        lines = [json.dumps({"id": i, "k": k, "ts": (T0 + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ"), "v": v}) for i, k, s, v in events]
        path = self.dir / f"{self.n:03}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + self.n,) * 2)  # files are read in the order of their times
        self.n += 1

    def stream(self):
        return generate.json_file_stream(self.spark, str(self.dir), SCHEMA)

    def drain(self, df, mode, write):
        st.start_query(df, self.checkpoint, mode, write=write).awaitTermination()


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def collected(store):
    return lambda df, _id: store.extend(tuple(r) for r in df.collect())


def test_late_rows_update_until_the_watermark_passes(landing):
    out = {}

    def keep(df, _id):
        out.update({r["window_start"]: r["total"] for r in df.collect()})

    def totals():
        timed = st.with_event_time(landing.stream(), F.col("ts"), "1 minute")
        return st.hourly_totals(timed, "event_time", "v")

    landing.put((1, "a", 60, 100.0), (2, "a", 120, 200.0))
    landing.drain(totals(), "update", keep)
    landing.put((3, "a", 3700, 150.0), (4, "a", 300, 1.0))
    landing.drain(totals(), "update", keep)
    assert list(out.values()) == [301.0, 150.0]
    landing.put((5, "a", 9000, 5.0))
    landing.put((6, "a", 9001, 5.0))
    landing.put((7, "a", 100, 999.0))
    landing.drain(totals(), "update", keep)
    assert list(out.values()) == [301.0, 150.0, 10.0]


def test_tumbling_hour_totals(spark):
    df = spark.createDataFrame([(T0 + timedelta(minutes=m), float(v)) for m, v in ((5, 100), (50, 200), (65, 150), (119, 300))], "ts timestamp_ntz, v double")
    assert [r["total"] for r in st.hourly_totals(df, "ts", "v").orderBy("window_start").collect()] == [300.0, 450.0]


def test_window_boundary_belongs_to_the_next_window(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 5), 1.0)], "ts timestamp_ntz, v double")
    r = st.sliding_average(df, "ts", "v", "5 minutes", "5 minutes").first()
    assert (r["window_start"].minute, r["window_end"].minute) == (5, 10)


def test_sliding_averages(spark):
    prices = [100, 120, 110, 130, 115, 125]
    df = spark.createDataFrame([(T0 + timedelta(minutes=i), float(p)) for i, p in enumerate(prices)], "ts timestamp_ntz, v double")
    got = {r["window_start"]: r["avg_value"] for r in st.sliding_average(df, "ts", "v", "5 minutes", "1 minute").collect()}
    assert got[T0] == 115.0 and got[T0 + timedelta(minutes=1)] == 120.0


def test_sessions_stream_equals_golden(landing):
    store = []

    def sessions():
        return st.session_activity(st.with_event_time(landing.stream(), F.col("ts"), "30 minutes"), "event_time", "k", "v", "5 minutes")

    landing.put(*[(i, "u", m * 60, 1.0) for i, m in enumerate((0, 3, 11, 13))])
    landing.put((9, "u", 120, 1.0))
    landing.put((10, "z", 7200, 1.0))
    landing.put((11, "z", 7201, 1.0))
    landing.drain(sessions(), "append", collected(store))
    assert sorted((r[0].minute, r[1].minute, r[3]) for r in store if r[2] == "u") == [(0, 8, 3), (11, 18, 2)]


def test_stream_candles_equal_batch(landing, spark):
    out = {}

    def keep(df, _id):
        out.update({(r["window_start"], r["symbol"]): tuple(r)[3:] for r in df.collect()})

    events = [(i, "ab"[i % 2], (i * 37) % 600, float((i * 7) % 50 + 1)) for i in range(60)]
    for i in range(0, 60, 20):
        landing.put(*events[i:i + 20])
    timed = st.with_event_time(landing.stream(), F.col("ts"), "1 hour")
    landing.drain(agg.ohlc(timed, "event_time", "k", "v", "id"), "update", keep)
    batch = spark.read.schema(SCHEMA).json(str(landing.dir))
    assert out == {(r["window_start"], r["symbol"]): tuple(r)[3:] for r in agg.ohlc(batch, "ts", "k", "v", "id").collect()}


def test_dedup_within_watermark(landing):
    store = []
    landing.put((1, "a", 0, 1.0), (1, "a", 0, 1.0), (2, "a", 1, 1.0))
    landing.put((1, "a", 0, 1.0), (3, "a", 2, 1.0))
    landing.drain(st.dedup_events(landing.stream(), ["k", "ts"], "ts", "1 minute"), "append", collected(store))
    assert sorted(r[0] for r in store) == [1, 2, 3]


def test_keyed_state_sums_and_expires(landing):
    store = []

    def activity():
        return st.keyed_activity(landing.stream(), "k", "ts", "v", "1 minute", ttl_minutes=30)

    landing.put((1, "a", 0, 1.0), (2, "a", 10, 2.0), (3, "b", 20, 5.0))
    landing.put((4, "a", 60, 4.0))
    landing.drain(activity(), "update", collected(store))
    assert [r[:3] for r in store if r[0] == "a"] == [("a", 2, 3.0), ("a", 3, 7.0)]
    store.clear()
    landing.put((5, "b", 7200, 1.0))
    landing.put((6, "b", 7201, 1.0))
    landing.drain(activity(), "update", collected(store))
    assert ("a", 3, 7.0, True) in [(r[0], r[1], r[2], r[4]) for r in store]


def test_orders_without_payment_fail_after_the_wait(spark, tmp_path):
    for name in "op":
        (tmp_path / name).mkdir()
    orders, payments = Landing(spark, tmp_path / "o"), Landing(spark, tmp_path / "p")
    store = []

    def matched():
        o = orders.stream().select(F.col("id").alias("order_id"), F.col("ts").alias("order_time"))
        p = payments.stream().select(F.col("id").alias("payment_order_id"), F.col("ts").alias("payment_time"))
        return st.match_payments(o, p).select("order_id", "status")

    orders.put((123, "A", 0, 0.0), (456, "B", 300, 0.0))
    payments.put((123, "A", 120, 0.0))
    for late in (7200, 7300, 7400):
        orders.put((late, "z", late, 0.0))
        payments.put((late, "z", late, 0.0))
    orders.drain(matched(), "append", collected(store))
    assert {r for r in store if r[0] < 1000} == {(123, "completed"), (456, "failed")}


def test_stream_static_enrichment(landing, spark):
    store = []
    names = spark.createDataFrame([("a", "Alpha")], "k string, name string")
    landing.put((1, "a", 0, 1.0), (2, "x", 0, 1.0))
    landing.drain(landing.stream().join(names, "k", "left").select("id", "name"), "append", collected(store))
    assert sorted(store) == [(1, "Alpha"), (2, None)]


def test_approximate_users_are_close(landing, spark):
    store = []
    landing.put(*[(i, "a", i % 60, float(i % 500)) for i in range(2000)])
    timed = st.with_event_time(landing.stream(), F.col("ts"), "1 minute")
    landing.drain(st.active_users(timed, "event_time", "k", "v"), "update", collected(store))
    assert abs(store[0][3] - 500) <= 50


def test_output_mode_policy():
    st.check_output_mode("append", aggregated=True, watermarked=True)
    st.check_output_mode("complete", aggregated=True, watermarked=False, bounded_result=True)
    for bad in (dict(mode="append", aggregated=True, watermarked=False), dict(mode="complete", aggregated=False, watermarked=False),
                dict(mode="complete", aggregated=True, watermarked=True), dict(mode="odd", aggregated=False, watermarked=False)):
        with pytest.raises(ValueError):
            st.check_output_mode(**bad)


def test_retry_then_success_and_reraise(spark, tmp_path):
    calls, pauses = [], []

    def flaky(df, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise OSError("down")

    st.retrying(flaky, str(tmp_path / "dlq"), sleep=pauses.append)(spark.range(2), 7)
    assert calls == [7, 7, 7] and pauses == [1, 2] and not (tmp_path / "dlq").exists()

    def broken(df, batch_id):
        raise OSError("down")

    with pytest.raises(OSError):
        st.retrying(broken, str(tmp_path / "dlq"), reraise=True, sleep=pauses.append)(spark.range(2), 8)
    assert spark.read.parquet(str(tmp_path / "dlq" / "batch_id=8")).count() == 2


def test_memory_sink_and_lifecycle(spark, landing):
    landing.put((1, "a", 0, 1.0), (2, "b", 0, 2.0))
    q = st.start_query(landing.stream(), landing.checkpoint, fmt="memory", name="mem_out", every="1 second")
    q.processAllAvailable()
    assert spark.table("mem_out").count() == 2
    report = st.progress_report(spark, q)
    assert report.agg(F.sum("input_rows")).first()[0] == 2 and report.where("query = 'mem_out'").count() == report.count()
    st.stop_all(spark)
    assert spark.streams.active == []


def test_rate_stream_columns(spark, tmp_path):
    q = st.start_query(generate.rate_stream(spark, 50, buckets=5, start_ms=1_700_000_000_000), str(tmp_path / "c"), fmt="memory", name="rate_out", every="1 second")
    q.awaitTermination(5)
    q.stop()
    got = spark.table("rate_out")
    assert got.count() > 0 and got.where("value_bucket <> value % 5").count() == 0


def test_upsert_sink_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    write = st.upsert_sink(spark, path, ["k", "b"], {"b": F.lit(0)}, stamp=True, processed_at=datetime(2024, 1, 1))
    batch = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for batch_id in (0, 0, 1):
        write(batch, batch_id)
    assert rows(spark.read.parquet(path), "k", "v", "batch_id") == [("a", 1, 1), ("b", 2, 1)]


def test_rate_limit_takes_one_file_per_batch(landing):
    sizes = []
    for i in range(3):
        landing.put((i, "a", i, 1.0))
    landing.drain(landing.stream(), "append", lambda df, _id: sizes.append(df.count()))
    assert sizes == [1, 1, 1]


def test_pagerank_of_four_nodes(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("d", "c"), ("d", "c"), ("d", "e")], "src string, dst string")
    out = {"a": {"b": .5, "c": .5}, "b": {"c": 1}, "c": {"a": 1}, "d": {"c": 2 / 3, "e": 1 / 3}, "e": {}}
    rank = dict.fromkeys(out, 1 / 5)
    for _ in range(10):
        lost = rank["e"]
        rank = {n: .15 / 5 + .85 * (sum(rank[s] * d.get(n, 0) for s, d in out.items()) + lost / 5) for n in out}
    got = {r["id"]: r["rank"] for r in graph.pagerank(edges).collect()}
    assert got == pytest.approx(rank) and sum(got.values()) == pytest.approx(1)


def test_classifier_separates(spark):
    df = spark.createDataFrame([(float(i), int(i > 50)) for i in range(100)], "x double, y int")
    scored = ml.score(ml.fit_classifier(df, ["x"], "y"), df)
    assert scored.where("prediction <> y").count() <= 2
