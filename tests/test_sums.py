"""Sums of doubles against exact fractions, in any order, over windows and through two aggregations."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from millrace.functions.sums import exact_avg, exact_sum, partial_sums, whole_sum
from millrace.operators import aggregates as agg
from millrace.operators import columns, quality, windows


def groups():
    rng = random.Random(1)
    special = [0.0, -0.0, 1.0, -1.0, 0.1, 0.01, 2.0**53, 2.0**-53, 1e27, 1e-13]
    out = []
    for _ in range(400):
        low, high = rng.choice([(-3, 3), (-12, 12), (-20, 25), (0, 0)])
        values = [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(low, high) if rng.random() < 0.9 else rng.choice(special) for _ in range(rng.choice([1, 2, 3, 5, 50]))]
        out.append(values + [-v for v in values] if rng.random() < 0.2 else values)
    out += [[1.0, 2.0**-53, tail] for tail in (0.0, 2.0**-60, -(2.0**-60), 2.0**-90)]  # ties and what breaks them
    return out


def exactly(values):
    return float(sum(map(Fraction, values)))


def test_sums_are_rounded_once(spark):
    every = groups()
    rows = [(g, v) for g, values in enumerate(every) for v in values]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    got = {r["g"]: r for r in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
    for g, values in enumerate(every):
        assert got[g]["s"] == exactly(values), values
        assert got[g]["a"] == exactly(values) / len(values)
    halves = df.groupBy("g", (F.col("v") > 0).alias("side")).agg(*partial_sums("v", "t")).groupBy("g").agg(whole_sum("t").alias("s"))
    assert all(r["s"] == exactly(every[r["g"]]) for r in halves.collect())


@pytest.mark.parametrize("values,want", [
    ([math.nan, 1.0], math.nan), ([math.inf, 1.0], math.inf), ([math.inf, -math.inf], math.nan), ([None], None), ([], None), ([None, 2.0], 2.0),
    ([1e300, 1e300], 2e300), ([1e-300, 1e-300], 2e-300), ([1e27], 1e27), ([1e-13] * 1000, exactly([1e-13] * 1000)), ([5e-324, 1.0], 1.0),
])
def test_special_values(spark, values, want):
    got = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v").alias("s")).first()["s"]
    assert got == want or math.isnan(want) and math.isnan(got)


def test_products_and_means_of_small_values(spark):
    sold = spark.createDataFrame([("a", 0.00001, 60000.0)] * 1000 + [("b", 0.00000012, 1e6)] * 10 + [("c", 1.0, 2e9)], "p string, amount double, quantity double")
    got = {r["p"]: r["total_sales"] for r in agg.sales_by_product(sold, "p", "amount", "quantity").collect()}
    assert got == {"a": exactly([0.00001 * 60000.0] * 1000), "b": exactly([0.00000012 * 1e6] * 10), "c": 2e9}
    assert math.isclose(got["a"], 600) and math.isclose(got["b"], 1.2)
    small = spark.createDataFrame([(0.00003,)] * 100 + [(None,)], "v double")
    assert quality.run_checks(small, [quality.mean_between("v", 0.00002, 0.00004)]).first()["passed"]
    assert columns.impute_mean(small, "v").where("v is null").count() == 0
    assert math.isnan(spark.createDataFrame([(math.nan,), (1.0,)], "v double").agg(exact_avg("v").alias("a")).first()["a"])


def test_plain_and_split_totals_are_the_same_bits(spark):
    rng = random.Random(4)
    rows = [(i % 2, i, rng.random() * 10 ** rng.randint(-9, 9) if i % 13 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, i int, v double").repartition(5)
    totals = [{(r["k"], r["i"]): r["t"] for r in windows.running_total(df, ["k"], ["i"], F.col("v"), "t", limit).collect()} for limit in (None, 40)]
    assert totals[0] == totals[1]
    for k in (0, 1):
        seen = []
        for _, i, v in sorted(r for r in rows if r[0] == k):
            seen += [] if v is None else [v]
            assert totals[0][k, i] == (exactly(seen) if seen else None)
