from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.operators import quality as q
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(1, "a@x.co", 20, "F"), (2, "B@x.co", 200, "M"), (2, None, -1, "Z"), (None, "c", 30, None)], "id int, email string, age int, sex string")


def report(df, *rules):
    return {(r["check"], r["column"]): r for r in q.run_checks(df, list(rules)).collect()}


def test_row_rules_and_details(users):
    out = report(users, q.not_null("id"), q.in_range("age", 0, 150), q.is_in("sex", ["F", "M"]), q.lowercase("email"), q.not_null("gone"))
    assert {k[0]: (r["passed"], r["failed_rows"]) for k, r in out.items() if k[1] != "gone"} == {
        "not_null": (False, 1), "in_range": (False, 2), "is_in": (False, 1), "lowercase": (False, 1)}
    assert out["in_range", "age"]["detail"] == "below=1 above=1"
    assert out["not_null", "gone"]["detail"] == "column not found: gone" and not out["not_null", "gone"]["passed"]


def test_row_and_metric_rules_take_one_pass(users):
    df = q.run_checks(users, [q.not_null("id"), q.in_range("age", 0), q.mean_between("age", 0, 100), q.rows_between(1)])
    text = plan(df)
    assert text.count("Scan ExistingRDD") == 1 and "Join" not in text


def test_unique_counts_nulls_as_duplicates(users):
    assert report(users, q.unique("id"))["unique", "id"]["failed_rows"] == 2
    assert report(users, q.no_duplicates(["id"]))["no_duplicates", "id"]["failed_rows"] == 1


def test_types_and_columns(users):
    out = report(users, q.types({"id": "numeric", "email": "string", "age": "bigint"}), q.columns_present(["id", "email"], strict=True))
    assert out["types", "id,email,age"]["detail"] == "age should be bigint, is int"
    assert out["strict_columns", "id,email"]["detail"] == "age is not expected; sex is not expected"


def test_freshness_modes(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 3),)], "ts timestamp_ntz")
    as_of = datetime(2024, 1, 3, 12)
    out = report(df, q.fresh("ts", as_of, 24), q.fresh("ts", as_of, 24, "oldest"))
    assert out["fresh_newest", "ts"]["passed"] and not out["fresh_oldest", "ts"]["passed"]
    assert not report(df.where("false"), q.fresh("ts", as_of, 24))["fresh_newest", "ts"]["passed"]


def test_empty_input_passes_ratio_gate(users):
    none = users.where("false")
    assert report(none, q.max_null_ratio("id", 0.5))["max_null_ratio", "id"]["passed"]
    assert report(users, q.max_null_ratio("id", 0.2))["max_null_ratio", "id"]["passed"] is False


def test_outliers(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1000.0,)], "v double")
    assert rows(q.outliers(df, "v")) == [(1000.0,)]
    assert report(df, q.no_outliers("v"))["no_outliers", "v"]["failed_rows"] == 1


def test_references_name_missing_values(spark):
    child, parent = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k int"), spark.createDataFrame([(1,)], "k int")
    r = report(child, q.references("k", parent, "k"))["references", "k"]
    assert (r["failed_rows"], r["detail"]) == (3, "7")


def test_cross_rules(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 2.0, 6.5), (5.0, 1.0, None)], "q double, p double, total double")
    rule = q.holds("total", ["q", "p", "total"], F.abs(F.col("total") - F.col("q") * F.col("p")) < 0.01)
    assert report(df, rule)["total", "q,p,total"]["failed_rows"] == 1


def test_mega_whales(spark):
    df = spark.createDataFrame([(5e5,), (2e6,), (1e6,), (10.0,)], "usd_value double")
    assert [r[0] for r in df.select(F.col("usd_value") > 1e6).collect()] == [False, True, False, False]


def test_severity_and_gates(users):
    with pytest.raises(q.QualityError, match=r"not_null\(id\): 1 of 4"):
        q.enforce(users, [q.not_null("id")])
    assert q.enforce(users, [q.not_null("id").warn()]) is users

    @q.check_input(q.rows_between(1))
    @q.check_output(q.not_null("id"))
    def passthrough(df):
        return df

    with pytest.raises(q.QualityError):
        passthrough(users)
    assert passthrough(users.where("id IS NOT NULL")).count() == 3
    with pytest.raises(q.QualityError, match="rows_between"):
        passthrough(users.where("false"))


def test_split_policies(users):
    checked = q.with_errors(users, [q.not_null("id"), q.in_range("age", 0, 150)])
    good, bad = q.split_valid(checked)
    assert rows(good, "id") == [(1,)] and bad.count() == 3
    good, bad = q.split_valid(checked, policy="batch")
    assert (good.count(), bad.count()) == (0, 4)
    good, bad = q.split_valid(checked.where("id = 1"), policy="batch")
    assert (good.count(), bad.count()) == (1, 0)


def test_failure_cases(users):
    got = rows(q.failure_cases(users, [q.not_null("id"), q.in_range("age", 0, 150)], ["email"]))
    assert got == sorted([("c", "id", "not_null", None), ("B@x.co", "age", "in_range", "200"), (None, "age", "in_range", "-1")],
                         key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def test_summary(users):
    s = q.summary(q.run_checks(users, [q.not_null("id"), q.not_null("sex").warn(), q.rows_between(1, 9)])).first()
    assert tuple(s) == (3, 1, 1, 1, False)


def test_observed_counts(users):
    df, seen = q.observed(users, "step", F.col("age") < 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows_in": 4, "rejected": 1}


def test_reconcile(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert rows(q.reconcile(a, b, ["k"])) == [(1, 1, 0, "missing_in_target"), (2, 2, 1, "count_differs"), (3, 0, 1, "extra_in_target")]


def test_runtime_model(spark):
    schema, rules = udfs.model_from_config({"id": {"type": "int", "min": 1}, "tag": {"type": "string", "required": False, "choices": ["a", "b"]}})
    assert schema.simpleString() == "struct<id:int,tag:string>" and [f.nullable for f in schema.fields] == [False, True]
    df = spark.createDataFrame([(0, "a"), (1, "c"), (2, None)], "id int, tag string")
    assert {c: r["failed_rows"] for (c, _), r in report(df, *rules).items()} == {"not_null": 0, "in_range": 1, "is_in": 1}


def test_named_checks(spark):
    df = spark.createDataFrame([(1, 50.0), (2, 101.0), (3, None)], "id int, humidity double")
    assert rows(udfs.offending_rows("range", df, "humidity"), "id") == [(2,)]
    assert rows(udfs.offending_rows("not_null", df, "humidity"), "id") == [(3,)]


def test_udf_twins(spark):
    df = spark.createDataFrame([("  jakarta selatan ", 37), (None, 40)], "c string, a int")
    got = df.select(udfs.normalize_city_udf("c"), udfs.normalize_city(F.col("c")), udfs.bucket_age_udf("a"), udfs.bucket_age(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [("Jakarta Selatan", "Jakarta Selatan", 30, 30), (None, None, 40, 40)]
