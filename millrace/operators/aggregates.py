"""Aggregation operators (A01-A23). Every one combines on the map side before its shuffle."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.sums import exact_avg, exact_sum
from millrace.operators.columns import attach_scalars
from millrace.operators.windows import exact_quantiles
from millrace.session import stage


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Revenue, quantity, count and average per category, region, year and month."""
    return sales.groupBy("category", "region", "year", "month").agg(
        exact_sum("amount").alias("total_revenue"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.count("transaction_id").alias("transactions_count"),
        exact_avg("amount").alias("avg_transaction_value"),
    )


def top_counts(df: DataFrame, key: str, n: int, extra: Sequence[Column] = ()) -> DataFrame:
    """The ``n`` most frequent keys; ties go by key."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"), *extra)
            .orderBy(F.col("count").desc(), F.col(key)).limit(n))


def column_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL count, smallest and largest value as text; one pass over the table."""
    cols = list(cols or df.columns)
    one = df.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"),
            F.min(c).cast("string").alias("min"),
            F.max(c).cast("string").alias("max"),
        ).alias(f"_p{i}") for i, c in enumerate(cols)
    ])
    return one.select(F.inline(F.array(*[F.col(f"_p{i}") for i in range(len(cols))])))


def column_describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per numeric column: count, mean, sample standard deviation, smallest and largest value; one pass over the table.

    The mean is rounded once; the deviation is a plain one, whose last digits depend on the order of rows.
    """
    one = df.agg(*[
        F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), exact_avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(f"_p{i}") for i, c in enumerate(cols)])
    return one.select(F.inline(F.array(*[F.col(f"_p{i}") for i in range(len(cols))])))


def conditional_pivot(df: DataFrame, keys: Sequence[str], label: str, value: Column, names: Mapping[str, str]) -> DataFrame:
    """One ``max(value)`` column per wanted label, in a single aggregation."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(label) == want, value)).alias(name) for want, name in names.items()])


def sales_by_product(df: DataFrame, product: str, amount: str, quantity: str, valid: Column | None = None) -> DataFrame:
    """Σ amount × quantity per product; rows without a product are skipped, a missing quantity is 1, a missing amount 0.

    Rows that are not ``valid`` do not count, and a product with no other rows is left out.
    """
    total = F.coalesce(F.col(amount).cast("double"), F.lit(0.0)) * F.coalesce(F.col(quantity).cast("double"), F.lit(1.0))
    sold = df.where(F.col(product).isNotNull() & (F.col(product) != "")).groupBy(product)
    if valid is None:
        return sold.agg(exact_sum(total).alias("total_sales"))
    sums = sold.agg(exact_sum(F.when(valid, total)).alias("total_sales"))
    return sums.where("total_sales IS NOT NULL")


def trade_summary(df: DataFrame, symbol: str, price: str, quantity: Column, batch_date: Column) -> DataFrame:
    return df.groupBy(F.col(symbol).alias("symbol"), batch_date.alias("batch_date")).agg(
        exact_avg(price).alias("avg_price"), F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        F.sum(quantity).alias("total_quantity"), F.count(F.lit(1)).alias("trade_count"))


def ohlc(df: DataFrame, ts: str, symbol: str, price: str, tie: str, width: str = "1 minute") -> DataFrame:
    """Open, high, low, close per window ``[start, end)`` and symbol.

    Open and close follow (time, tie), so the result does not depend on row order.
    """
    pos = F.struct(ts, tie)
    return (
        df.groupBy(F.window(ts, width).alias("_w"), F.col(symbol).alias("symbol"))
        .agg(F.min_by(price, pos).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
             F.max_by(price, pos).alias("close"))
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
                "symbol", "open", "high", "low", "close")
    )


def hour_bucket(ts: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide bucket that restarts each hour (45 gives :00 and :45)."""
    hour = F.date_trunc("hour", ts)
    step = (F.floor(F.minute(ts) / minutes) * minutes).cast("int")
    return hour + F.make_dt_interval(mins=step)


def rollup_candles(candles: DataFrame, minutes: int) -> DataFrame:
    """Wider candles from 1-minute candles."""
    return candles.groupBy(hour_bucket(F.col("window_start"), minutes).alias("time"), "symbol").agg(
        F.min_by("open", "window_start").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max_by("close", "window_start").alias("close"))


def change_first_last(df: DataFrame, symbol: str, order: Sequence[str], price: str) -> DataFrame:
    """Percent change from the first to the last price per symbol, in one aggregation."""
    pos = F.struct(*order)
    first, last = F.min_by(price, pos), F.max_by(price, pos)
    return df.groupBy(symbol).agg(first.alias("first_price"), last.alias("last_price")).withColumn(
        "pct_change", F.try_divide(F.col("last_price") - F.col("first_price"), F.col("first_price")) * 100)


def daily_revenue(orders: DataFrame, ts: str, amount: str) -> DataFrame:
    return orders.groupBy(F.to_date(ts).alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"), exact_sum(amount).alias("total_revenue"),
        exact_avg(amount).alias("avg_order_value"))


def lifetime_value(orders: DataFrame, customer: str, amount: str) -> DataFrame:
    return orders.groupBy(customer).agg(exact_sum(amount).alias("lifetime_value"), F.count(F.lit(1)).alias("orders"))


def customer_cohorts(orders: DataFrame, customer: str, ts: str) -> DataFrame:
    """Active customers per first-order month and months since then.

    Orders are first reduced to one row per customer and month.
    """
    month = F.trunc(F.to_date(ts), "month")
    active = orders.select(customer, month.alias("month")).distinct()
    first = active.groupBy(customer).agg(F.min("month").alias("cohort"))
    since = F.months_between("month", "cohort").cast("int")
    return (active.join(first, customer).groupBy("cohort", since.alias("months_since"))
            .agg(F.count(F.lit(1)).alias("customers")))


def recent_mean(df: DataFrame, key: str, ts: str, value: str, as_of: datetime, days: int = 7) -> DataFrame:
    """Mean per key over the ``days`` before ``as_of``."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days))
    recent = df.where((F.col(ts) >= start) & (F.col(ts) < F.lit(as_of).cast("timestamp_ntz")))
    return recent.groupBy(key).agg(exact_avg(value).alias("mean_value")).withColumn("as_of", F.lit(as_of).cast("timestamp_ntz"))


def mention_counts(docs: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """Documents that mention each keyword as a whole word, in any case; keywords without a mention stay with 0.

    One scan and one aggregated row, turned into one row per keyword.
    """
    edge = r"[^\p{L}\p{N}_]"
    low = docs.select(F.lower(text).alias("_low"))
    # The plain substring test spares most texts the pattern.
    words = [k.lower() for k in keywords]
    hits = low.agg(*[F.count_if(F.col("_low").contains(k) & F.col("_low").rlike(f"(^|{edge}){re.escape(k)}($|{edge})")).alias(f"_k{i}")
                     for i, k in enumerate(words)])
    pairs = [F.struct(F.lit(k).alias("keyword"), F.coalesce(f"_k{i}", F.lit(0)).alias("documents")) for i, k in enumerate(keywords)]
    return hits.select(F.inline(F.array(*pairs)))


def iqr_bounds(df: DataFrame, keys: Sequence[str], value: str, multiplier: float = 3.0,
               max_group_rows: int | None = None) -> DataFrame:
    """Quartiles and outlier bounds per group."""
    q = exact_quantiles(df, keys, value, [0.25, 0.75], ["q1", "q3"], max_group_rows)
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"lower": F.col("q1") - multiplier * iqr, "upper": F.col("q3") + multiplier * iqr})


def dq_metrics(df: DataFrame, symbol: str, ts: str, price: str, as_of: datetime, fresh_seconds: int = 300) -> DataFrame:
    """Totals, freshness and invalid prices of a price table in one pass."""
    now = F.lit(as_of).cast("timestamp_ntz").cast("timestamp")
    one = df.agg(F.count(F.lit(1)).alias("total_records"), F.countDistinct(symbol).alias("unique_symbols"),
                 F.max(ts).alias("latest_timestamp"), F.count_if(F.col(price) <= 0).alias("invalid_prices"))
    age = (F.unix_micros(now) - F.unix_micros(F.col("latest_timestamp").cast("timestamp"))) / 1_000_000
    return one.withColumn("data_age_seconds", age).withColumn("is_fresh", F.col("data_age_seconds") < fresh_seconds)


def symbol_completeness(df: DataFrame, symbol: str, expected: Sequence[str]) -> DataFrame:
    """Rows seen per expected symbol; missing ones stay with 0."""
    one = df.agg(*[F.count_if(F.col(symbol) == s).alias(f"_s{i}") for i, s in enumerate(expected)])
    pairs = [F.struct(F.lit(s).alias("symbol"), F.col(f"_s{i}").alias("rows"), (F.col(f"_s{i}") > 0).alias("present"))
             for i, s in enumerate(expected)]
    return one.select(F.inline(F.array(*pairs)))


def rows_on_date(df: DataFrame, ts: str, day: date, table: str) -> DataFrame:
    """Row count and newest time of one day; the range filter reaches the scan."""
    start = F.lit(day).cast("timestamp_ntz")
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.make_dt_interval(days=F.lit(1)))).agg(
        F.count(F.lit(1)).alias("rows"), F.max(ts).alias("latest")).select(F.lit(table).alias("table_name"), "rows", "latest")


def partition_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def key_share(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and share of all rows."""
    counts = stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), "counts")
    total = counts.agg(F.sum("rows").alias("_all"))
    shared = attach_scalars(counts, total)
    return shared.withColumn("share", F.col("rows") / F.col("_all")).drop("_all")
