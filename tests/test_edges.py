"""Inputs that the tables do not hold: NULL keys, repeated keys, sub-cent values, large ids, other case."""

from datetime import datetime

import pytest

from millrace.operators import aggregates as agg
from millrace.operators import joins, upsert
from millrace.operators.dimensional import scd2, scd2_open
from millrace.sources.generate import generate_sales
from tests.conftest import plan, rows


def table(spark, path):
    return rows(spark.read.schema("k string, v int, p string").parquet(path), "k", "v", "p")


def test_null_partition_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 1, "d1")], "k string, v int, p string")
    upsert.upsert_table(spark, path, first, ["k"], ["p"])
    upsert.upsert_table(spark, path, spark.createDataFrame([("z", 2, None)], first.schema), ["k"], ["p"])
    assert sorted(r[0] for r in table(spark, path)) == ["a", "b", "c", "z"]


def test_replay_with_null_key_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(None, 1, "d"), ("x", 1, "d")], "k string, v int, p string")
    for _ in range(3):
        upsert.upsert_table(spark, path, batch, ["k"], ["p"])
        upsert.upsert_table(spark, path, batch, ["k"], ["p"], rules={"v": "greatest"})
    assert len(table(spark, path)) == 2
    assert upsert.insert_ignore(batch, batch, ["k"], ["v"]).count() == 0


def test_repeated_batch_key_is_refused_or_ordered(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("x", 1, "d"), ("x", 2, "d")], "k string, v int, p string")
    with pytest.raises(ValueError):
        upsert.upsert_table(spark, path, batch, ["k"], ["p"])
    upsert.upsert_table(spark, path, batch, ["k"], ["p"], order=[batch["v"].desc()])
    assert table(spark, path) == [("x", 2, "d")]


def test_upsert_in_a_micro_batch_reads_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.createDataFrame([("a", 1, "d3"), ("b", 1, "d5")], "k string, v int, p string")
    upsert.upsert_table(spark, path, days, ["k"], ["p"])
    (next((tmp_path / "t" / "p=d5").glob("*.parquet"))).write_bytes(b"broken")
    upsert.upsert_table(spark, path, spark.createDataFrame([("a", 7, "d3")], days.schema), ["k"], ["p"])
    assert rows(spark.read.schema(days.schema).parquet(path).where("p = 'd3'"), "k", "v") == [("a", 7)]


def test_scd2_null_key_has_one_current_version(spark):
    snapshot = spark.createDataFrame([(None, "x"), ("b", "y")], "k string, name string")
    dim = scd2_open(snapshot, ["k"], ["name"], datetime(2024, 1, 1))
    again = scd2(dim, snapshot, ["k"], ["name"], datetime(2024, 2, 1))
    assert again.where("is_current").count() == 2 and again.count() == 2


def test_sums_keep_small_and_large_values(spark):
    small = spark.range(1000).selectExpr("0.004D as v").agg(agg.exact_sum("v").alias("s")).first()[0]
    large = spark.createDataFrame([(1e17,)], "v double").agg(agg.exact_sum("v").alias("s")).first()[0]
    assert small == 4.0 and large == 1e17
    half = agg.sales_by_product(spark.createDataFrame([("p", 10.0, 0.5)], "p string, a double, q double"), "p", "a", "q")
    assert half.first()["total_sales"] == 5.0


def test_ids_beyond_six_digits_stay_unique(spark):
    sales = generate_sales(spark, 1_000_020)
    assert sales.select("transaction_id").distinct().count() == 1_000_020


def test_null_series_has_no_value_as_of(spark):
    left = spark.createDataFrame([(5, None), (5, "s")], "t int, s string")
    right = spark.createDataFrame([(1, None, 9), (1, "s", 3)], "t int, s string, v int")
    out = joins.asof_join(left, right, "t", "t", ["s"], {"v": "v"})
    assert rows(out, "s", "v") == sorted([(None, None), ("s", 3)], key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def test_keywords_in_any_case_and_with_marks(spark):
    docs = spark.createDataFrame([("Gold and C++ here",), ("golden",)], "text string")
    assert rows(agg.mention_counts(docs, "text", ["Gold", "c++", "a.d"])) == [("Gold", 1), ("a.d", 0), ("c++", 1)]


def test_salted_and_split_joins_really_split(spark):
    big = spark.range(1000).selectExpr("id", "case when id < 600 then 1 else id end as k")
    small = spark.range(1000).selectExpr("id as k", "id * 2 as w")
    want = rows(big.join(small, "k"), "id", "w")
    salted = joins.salted_join(big, small, "k", ["id"], max_key_rows=100)
    split = joins.split_skew_join(big, small, "k", ["id"], max_key_rows=100)
    assert "_salt" in plan(salted) and "LeftAnti" in plan(split)
    assert rows(salted, "id", "w") == want and rows(split, "id", "w") == want
