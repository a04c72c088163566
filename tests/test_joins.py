from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins
from tests.conftest import rows


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.createDataFrame([(i, "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{i % 7}") for i in range(200)], "id int, key string")
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("none", 5), (None, 6)], "key string, v int")
    return big, small


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain(sides, how):
    big, small = sides
    assert rows(joins.salted_join(big, small, "key", ["id"], how, 10), "id", "key", "v") == rows(big.join(small, "key", how), "id", "key", "v")


def test_salted_join_refuses_right_outer(sides):
    with pytest.raises(ValueError):
        joins.salted_join(*sides, "key", ["id"], "right")


def test_split_skew_join_equals_plain(sides, monkeypatch):
    big, small = sides
    want = rows(big.join(small, "key"), "id", "key", "v")
    assert rows(joins.split_skew_join(big, small, "key", ["id"], 10), "id", "key", "v") == want
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 1)
    monkeypatch.setattr(joins, "is_small", lambda df: False)
    assert rows(joins.split_skew_join(big, small, "key", ["id"], 10), "id", "key", "v") == want


def test_hot_keys_count_pieces(sides):
    assert rows(joins.hot_keys(sides[0], "key", 50)) == [("hot", 2)]


def test_is_small_checks_rows_and_bytes(spark):
    df = spark.range(100).select(F.lpad(F.col("id").cast("string"), 1000, "x").alias("x"))
    assert joins.is_small(df)
    assert not joins.is_small(df, max_rows=99)
    assert not joins.is_small(df, max_bytes=50_000)


def test_orphans_null_rule(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert rows(joins.orphans(child, parent, "k", "p")) == [(2,), (None,)]
    assert rows(joins.orphans(child, parent, "k", "p", null_is_orphan=False)) == [(2,)]


def test_await_match_boundary(spark):
    at = lambda m, s=0: datetime(2024, 1, 1, 10, m, s)
    orders = spark.createDataFrame([(123, "A", at(0)), (456, "B", at(5)), (789, "C", at(0))], "order_id int, u string, t timestamp_ntz")
    paid = spark.createDataFrame([(1, "A", at(2)), (2, "B", at(20, 1)), (3, "C", at(15))], "pid int, u string, p timestamp_ntz")
    out = joins.await_match(orders, paid, ["u"], "t", "p", "pid", 900)
    assert rows(out, "order_id", "pid", "status") == [(123, 1, "completed"), (456, None, "failed"), (789, 3, "completed")]


def test_coalesce_sources_prefers_primary(spark):
    p = spark.createDataFrame([(1, 10), (2, None)], "k int, v int")
    s = spark.createDataFrame([(2, 99), (3, 30)], "k int, v int")
    assert rows(joins.coalesce_sources(p, s, ["k"], ("api", "cache"))) == [(1, 10, "api"), (2, None, "api"), (3, 30, "cache")]
