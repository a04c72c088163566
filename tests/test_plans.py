"""Plan shapes and house rules that must hold at any scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from millrace.functions import udfs
from millrace.operators import aggregates as agg
from millrace.operators import joins, windows
from millrace.plans import catalog
from tests.conftest import SF, plan

ROOT = Path(__file__).resolve().parents[1]
LIBRARY = sorted(p for p in (ROOT / "millrace").rglob("*.py") if "llm" not in p.parts)


def test_small_dimension_is_broadcast(t):
    df = t.customer.join(joins.checked_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    assert "BroadcastHashJoin" in plan(df)


def test_large_side_is_not_hinted(t):
    df = joins.checked_broadcast(t.orders, max_rows=10)
    assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_merge_hint_gives_sort_merge_join(t):
    assert "SortMergeJoin" in plan(t.lineitem.join(t.orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")))


def test_filters_and_columns_reach_the_scan(t):
    df = t.orders.where("o_totalprice > 400000").select("o_orderkey")
    text = plan(df)
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_dedup_and_topn_limit_before_the_shuffle(t):
    dedup = plan(windows.dedup_rows(t.lineitem, ["l_orderkey"], ["l_partkey"]))
    top = plan(windows.top_per_group(t.events, ["event_type"], [F.col("value").desc()], 2))
    for text in (dedup, top):
        assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", text)


def test_asof_join_has_no_range_join(t):
    series = t.lineitem.groupBy(F.col("l_shipdate").alias("d")).agg(F.sum("l_quantity").alias("v"))
    text = plan(joins.asof_join(t.orders.select("o_orderkey", "o_orderdate"), series, "o_orderdate", "d", [], {"v": "v"}))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_candles_combine_before_the_shuffle(t):
    text = plan(agg.ohlc(t.events, "ts", "event_type", "value", "event_id"))
    assert text.count("Aggregate(") >= 2 and "partial_max" in text


def test_native_twins_need_no_python(t):
    assert "Python" not in plan(t.part.select(udfs.bucket_age(F.col("p_size"))))
    assert "ArrowEvalPython" in plan(t.part.select(udfs.bucket_age_udf("p_size")))


@pytest.mark.parametrize("name", ["a01_monthly_sales", "c02_parse_amounts", "c08_validate_users", "q10_cross_column", "j12_split_skew_join", "w05_lag_lead", "x06_explode_json_array", "a19_mention_counts"])
def test_hot_paths_stay_in_the_jvm(spark, name):
    text = plan(driver.queries()[name](spark, SF))
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_no_driver_side_or_unbounded_code():
    allowed = {"quality.py": 1,  # the report of a gate: one row per rule
               "upsert.py": 1}  # partition values of a batch, bounded by the batch alone
    for path in LIBRARY:
        text = path.read_text()
        assert len(re.findall(r"\.collect\(\)", text)) <= allowed.get(path.name, 0), path
        for word in ("toPandas", "localCheckpoint", "crossJoin", ".rdd", "toLocalIterator", "monotonically_increasing_id"):
            assert word not in text, (path, word)


def test_queries_and_checks_have_plain_names():
    for name in catalog.QUERIES:
        assert re.fullmatch(r"[a-z]\d\d_[a-z0-9_]+", name)
    ids = {n[:3] for n in catalog.QUERIES}
    for family, last in (("p", 19), ("a", 23), ("w", 10), ("o", 4), ("x", 6), ("c", 23), ("e", 12), ("q", 24)):
        missing = {f"{family}{i:02}" for i in range(1, last + 1)} - ids
        assert not missing, missing
