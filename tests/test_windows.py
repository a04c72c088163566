"""Window operators: the split path equals the plain path and a Python brute force, with one hot key."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, joins, windows
from millrace.operators.runs import RUN, split_runs
from tests.conftest import rows

LIMIT = 20  # every group is cut
LIMITS = (1000, 60, LIMIT)  # none is cut, only the hot one, all
KEYS, ORDER = ["k"], ["ts", "id"]


def ticks():
    """300 rows, more than a third of them of one key, with repeated times, NULL keys and NULL values."""
    r = random.Random(7)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(300):
        key = "hot" if i % 5 < 2 else r.choice(["a", "b", "c", None])
        value = None if r.random() < 0.2 else Decimal(r.randrange(1, 40))
        out.append((i, key, start + timedelta(minutes=r.randrange(0, 400)), value))
    return out


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ticks(), "id long, k string, ts timestamp_ntz, v decimal(10,2)").repartition(4).cache()


def groups(reverse=False):
    by = {}
    for i, k, ts, v in sorted(ticks(), key=lambda x: (x[2], x[0]), reverse=reverse):
        by.setdefault(k, []).append((i, ts, v))
    return by


def test_runs_are_balanced_and_contiguous(df):
    runs = split_runs(df, KEYS, ORDER, LIMIT)
    assert runs.rest.count() == 0
    sizes = [r["count"] for r in runs.rows.groupBy(RUN).count().collect()]
    assert sum(sizes) == 300 and max(sizes) <= 2 * LIMIT
    crossing = runs.rows.groupBy(RUN).agg(F.count_distinct(F.coalesce("k", F.lit("-"))).alias("n")).agg(F.sum("n")).first()[0]
    assert crossing <= len(sizes) + 5 - 1  # one group per boundary at most


def test_small_groups_keep_the_plain_window(df):
    assert split_runs(df, KEYS, ORDER, 1000) is None
    hot = split_runs(df, KEYS, ORDER, 60)
    assert [r[0] for r in hot.rows.select("k").distinct().collect()] == ["hot"]
    assert hot.rows.count() + hot.rest.count() == 300 and hot.rest.where("k = 'hot'").count() == 0


def both(fn):
    plain, mixed, split = (rows(fn(limit)) for limit in LIMITS)
    assert mixed == plain
    return plain, split


def test_running_total(df):
    plain, split = both(lambda n: windows.running_total(df, KEYS, ORDER, F.col("v"), "s", n).select("id", "s"))
    want = []
    for g in groups().values():
        s = None
        for i, _ts, v in g:
            s = v if s is None else s + (v or 0)
            want.append((i, s))
    assert plain == split == sorted(want)


def test_row_numbers(df):
    plain, split = both(lambda n: windows.row_numbers(df, KEYS, ORDER, "rn", n).select("id", "rn"))
    assert plain == split == sorted((i, n) for g in groups().values() for n, (i, *_r) in enumerate(g, 1))


def test_lag_lead(df):
    plain, split = both(lambda n: windows.lag_lead(df, KEYS, ORDER, "id", "p", "n", n).select("id", "p", "n"))
    want = []
    for g in groups().values():
        ids = [i for i, *_r in g]
        want += [(i, ids[x - 1] if x else None, ids[x + 1] if x + 1 < len(ids) else None) for x, i in enumerate(ids)]
    key = lambda r: r[0]
    assert sorted(plain, key=key) == sorted(split, key=key) == sorted(want, key=key)


def test_locf(df):
    plain, split = both(lambda n: windows.locf(df, KEYS, ORDER, "v", "f", n).select("id", "f"))
    want = []
    for g in groups().values():
        last = None
        for i, _ts, v in g:
            last = v if v is not None else last
            want.append((i, last))
    key = lambda r: r[0]
    assert sorted(plain, key=key) == sorted(split, key=key) == sorted(want, key=key)


def test_rank(df):
    for descending in (True, False):
        plain, split = both(lambda n: windows.rank_in_group(df.where("v IS NOT NULL"), KEYS, "v", "r", descending, n).select("id", "r"))
        want = []
        for g in groups().values():
            vs = [v for *_x, v in g if v is not None]
            want += [(i, 1 + sum((o > v) if descending else (o < v) for o in vs)) for i, _t, v in g if v is not None]
        assert plain == split == sorted(want)


def test_moving_average(df):
    plain, split = both(lambda n: windows.moving_average(df, KEYS, "ts", F.col("v"), 1800, "m", n).select("id", F.round("m", 9)))
    want = []
    for g in groups().values():
        for i, ts, _v in g:
            near = [v for _j, u, v in g if v is not None and ts - timedelta(seconds=1800) <= u <= ts]
            want.append((i, round(float(sum(near)) / len(near), 9) if near else None))
    key = lambda r: r[0]
    assert sorted(plain, key=key) == sorted(split, key=key) == sorted(want, key=key)


def test_sessionize(df):
    plain, split = both(lambda n: windows.sessionize(df, KEYS, "ts", "id", 300, "s", n).select("id", "s"))
    want = []
    for g in groups().values():
        n, prev = 0, None
        for i, ts, _v in g:
            n += prev is None or ts - prev > timedelta(seconds=300)
            prev = ts
            want.append((i, n))
    assert plain == split == sorted(want)


def test_drop_repeats(df):
    fp = F.floor(F.col("id") / 50)
    plain, split = both(lambda n: windows.drop_repeats(df, KEYS, ORDER, fp, n).select("id"))
    want = []
    for g in groups().values():
        prev = None
        for i, *_r in g:
            if prev is None or i // 50 != prev:
                want.append((i,))
            prev = i // 50
    assert plain == split == sorted(want)


def test_exact_quantiles(df):
    import numpy as np

    for keys in (["k"], []):
        plain, split = both(lambda n: windows.exact_quantiles(df.withColumn("v", F.col("v").cast("double")), keys, "v", [0.25, 0.5, 0.75], ["a", "b", "c"], n))
        assert plain == split
    want = np.quantile([float(v) for *_x, v in ticks() if v is not None], [0.25, 0.5, 0.75])
    assert split[0] == pytest.approx(tuple(want))


def test_asof_join_split_equals_brute_force(df):
    left = df.select("id", "k", "ts")
    right = df.where("v IS NOT NULL AND id % 3 = 0").groupBy("k", "ts").agg(F.max("id").alias("rid"))
    marks = {}
    for i, k, ts, v in ticks():
        if v is not None and i % 3 == 0:
            marks.setdefault(k, {})[ts] = max(i, marks.get(k, {}).get(ts, -1))
    for direction in ("backward", "forward"):
        want = []
        for i, k, ts, _v in ticks():
            times = [u for u in marks.get(k, {}) if k is not None and (u <= ts if direction == "backward" else u >= ts)]  # NULL matches nothing
            best = (max(times) if direction == "backward" else min(times)) if times else None
            want.append((i, marks[k][best] if times else None))
        for limit in LIMITS:
            got = joins.asof_join(left, right, "ts", "ts", ["k"], {"rid": "rid"}, direction, limit).select("id", "rid")
            assert sorted(map(tuple, got.collect())) == sorted(want, key=lambda r: r[0])


def test_iqr_bounds_hot_group(df):
    d = df.withColumn("v", F.col("v").cast("double"))
    assert rows(aggregates.iqr_bounds(d, ["k"], "v", 3.0, 1000)) == rows(aggregates.iqr_bounds(d, ["k"], "v", 3.0, LIMIT))


def test_price_alert_levels(spark):
    prices = spark.createDataFrame([("BTC", 1, 50000.0), ("BTC", 2, 57500.0), ("BTC", 3, 58000.0), ("BTC", 4, 29000.0), ("ETH", 1, 10.0)], "s string, n int, p double")
    out = windows.price_alerts(prices, "s", ["n"], "p")
    assert rows(out, "s", "n", "severity", "message") == [("BTC", 2, "MEDIUM", "Price changed 15.00%"), ("BTC", 4, "HIGH", "Price changed -50.00%")]


def test_moving_average_splits_groups_of_many_marks(spark, monkeypatch):
    from millrace.operators import runs

    made, split = [], runs.split_runs
    monkeypatch.setattr(runs, "split_runs", lambda *a: made.append(split(*a)) or made[-1])
    df = spark.range(400).selectExpr("id", "'a' AS k", "timestamp_seconds(id * 60) AS ts", "CAST(id % 7 AS DECIMAL(18,2)) AS v")
    plain = windows.moving_average(df, ["k"], "ts", F.col("v"), 3600, "m").select("id", "m").collect()
    monkeypatch.setattr(windows, "MARK_ROWS", 100)
    assert sorted(windows.moving_average(df, ["k"], "ts", F.col("v"), 3600, "m").select("id", "m").collect()) == sorted(plain)
    assert made[0] is None and made[1] is not None
