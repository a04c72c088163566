"""End-to-end jobs (E01-E12) composed from the operators.

Each job takes its input and the folder to write to, and returns the result it wrote.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.operators import aggregates as agg
from millrace.operators import columns as cols
from millrace.operators import joins, quality, reshape, upsert, windows
from millrace.operators.dimensional import dim_from_source
from millrace.session import stage
from millrace.sources import contracts, files, sinks
from millrace.streaming import core as st
from millrace.streaming.lifecycle import run_together

# Commodities, currencies and macro series of the commodity mart.
COMMODITIES = ("gold", "silver", "platinum", "nickel", "copper")
MART_CURRENCIES = ("IDR", "EUR", "JPY", "CNY")
MACRO_SERIES = {"CPIAUCSL": "Consumer Price Index", "DTWEXBGS": "US Dollar Index", "DGS10": "10-Year Treasury Yield"}
MACRO_COLUMNS = {"CPIAUCSL": "cpi", "DTWEXBGS": "usd_index", "DGS10": "treasury_yield"}
DIM_COMMODITY = (
    ("gold", "Gold", "precious", "USD/g", "USD", "API"), ("silver", "Silver", "precious", "USD/g", "USD", "API"),
    ("platinum", "Platinum", "precious", "USD/g", "USD", "API"), ("nickel", "Nickel", "industrial", "USD/g", "USD", "API"),
    ("copper", "Copper", "industrial", "USD/g", "USD", "API"),
)
DIM_CURRENCY = (
    ("USD", "US Dollar", "United States", True, "API"), ("IDR", "Indonesian Rupiah", "Indonesia", False, "API"),
    ("EUR", "Euro", "European Union", False, "API"), ("JPY", "Japanese Yen", "Japan", False, "API"),
    ("CNY", "Chinese Yuan", "China", False, "API"),
)

COMMODITY_RAW = (
    "timestamp string, metals struct<status:string, timestamp:string, currency_base:string, metals:struct<"
    + ", ".join(f"{c}:double" for c in COMMODITIES) + ">>, currency struct<date:string, base:string, rates:struct<"
    + ", ".join(f"{c}:double" for c in MART_CURRENCIES) + ">>, macro string, news struct<timestamp:string, "
    + ", ".join(f"{c}:bigint" for c in COMMODITIES) + ">"
)


# --- E01 commodity mart --------------------------------------------------------------------


def stage_commodity(raw: DataFrame) -> DataFrame:
    """Prices and news counts as flat columns, one row per raw record."""
    fields = {"execution_timestamp": ("timestamp", "string"), "metal_timestamp": ("metals.timestamp", "string"),
              "news_timestamp": ("news.timestamp", "string"), "currency_base": ("metals.currency_base", "string")}
    fields |= {f"{c}_price": (f"metals.metals.{c}", "double") for c in COMMODITIES}
    fields |= {f"{c}_news_count": (f"news.{c}", "bigint") for c in COMMODITIES}
    return reshape.flatten_fields(raw, fields)


def stage_currency(raw: DataFrame) -> DataFrame:
    return reshape.flatten_fields(raw, {"currency_date": ("currency.date", "string"), "currency_base": ("currency.base", "string"),
                                        **{f"currency_{c.lower()}": (f"currency.rates.{c}", "double") for c in MART_CURRENCIES}})


def stage_macro(raw: DataFrame) -> DataFrame:
    """One value per series and day; of several values of a day the smallest is kept."""
    seen = reshape.explode_observations(raw, "macro", series=list(MACRO_SERIES))
    return windows.dedup_rows(seen, ["series_id", "date"], ["value"])


def fact_prices(staged: DataFrame) -> DataFrame:
    days = staged.withColumn("date", _day("metal_timestamp"))
    return reshape.unpivot_values(days, ["date", "currency_base"], {f"{c}_price": c for c in COMMODITIES}, "commodity_id", "price")


def fact_news(staged: DataFrame) -> DataFrame:
    days = staged.withColumn("date", _day("news_timestamp"))
    return reshape.unpivot_values(days, ["date"], {f"{c}_news_count": c for c in COMMODITIES}, "commodity_id", "news_count")


def fact_rates(staged: DataFrame) -> DataFrame:
    days = staged.withColumns({"date": _day("currency_date"), "base_currency": F.col("currency_base")})
    return reshape.unpivot_values(days, ["date", "base_currency"], {f"currency_{c.lower()}": c for c in MART_CURRENCIES}, "target_currency", "rate")


def fact_macro(staged: DataFrame) -> DataFrame:
    return staged.select(_day("date").alias("date_col"), F.col("date").alias("date_str"), "series_id", "value")


def _day(col: str) -> Column:
    return F.try_to_timestamp(F.col(col)).cast("date")


def commodity_mart(prices: DataFrame, news: DataFrame, rates: DataFrame, macro: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Price, news, local prices and the latest macro values known on each day.

    The macro values are looked up once per distinct day, then joined to the prices.
    """
    usd = rates.where((F.col("base_currency") == "USD") & F.col("target_currency").isin(*MART_CURRENCIES))
    # The highest rate of a day wins; max() per currency is that dedup and the pivot in one.
    fx = agg.conditional_pivot(usd, ["date"], "target_currency", F.col("rate"), {c: f"rate_to_{c.lower()}" for c in MART_CURRENCIES})
    days = prices.select("date").distinct()
    for series, name in MACRO_COLUMNS.items():
        one = macro.where(F.col("series_id") == series).select(F.col("date_col").alias("d"), F.col("value").alias("v"))
        days = joins.asof_join(days, one, "date", "d", [], {"v": f"{name}_value", "d": f"{name}_date"}, max_group_rows=max_group_rows)
    out = prices.join(news, ["date", "commodity_id"], "left").join(fx, "date", "left").join(days, "date", "left")
    return out.select("date", "commodity_id", "price", "news_count",
                      *[(F.col("price") * F.col(f"rate_to_{c}")).alias(f"{c}_price") for c in ("idr", "jpy", "cny", "eur")],
                      *[f"{n}_{k}" for n in MACRO_COLUMNS.values() for k in ("value", "date")])


STAGED_NOT_NULL = ("execution_timestamp", "metal_timestamp", *[f"{c}_price" for c in COMMODITIES], "gold_news_count")


def run_commodity_mart(spark: SparkSession, raw_path: str, out: str) -> DataFrame:
    """Raw NDJSON to dimensions, facts and the mart under ``out``. Raw days are kept, not truncated."""
    # The JSON is parsed once; every model below reads only its columns of the staged copy.
    raw = stage(files.read_json(spark, raw_path, COMMODITY_RAW), "commodity-raw")
    commodity, macro = stage_commodity(raw), stage(stage_macro(raw), "commodity-macro")
    quality.enforce(commodity, [quality.not_null(c) for c in STAGED_NOT_NULL])
    quality.enforce(macro, [quality.unique(F.concat_ws("-", "series_id", "date"), "series_id-date"), quality.not_null("value")])
    files.seed_table(spark, DIM_COMMODITY, "commodity_id string, commodity_name string, commodity_type string, unit string, price_currency string, source string"
                     ).write.mode("overwrite").parquet(f"{out}/dim_commodity")
    files.seed_table(spark, DIM_CURRENCY, "currency_code string, currency_name string, region string, is_base_reference boolean, source string"
                     ).write.mode("overwrite").parquet(f"{out}/dim_currency")
    dim_from_source(macro, "series_id", MACRO_SERIES, "series_name", "Unknown Series",
                    {"frequency": "daily", "units": "raw_value", "source": "FRED"}).write.mode("overwrite").parquet(f"{out}/dim_macro_series")
    facts = {"fact_commodity_prices": fact_prices(commodity), "fact_commodity_news": fact_news(commodity),
             "fact_currency_exchange_rates": fact_rates(stage_currency(raw)), "fact_macro_observations": fact_macro(macro)}
    for name, fact in facts.items():
        fact.write.mode("overwrite").parquet(f"{out}/{name}")
    saved = [spark.read.parquet(f"{out}/{name}") for name in facts]
    commodity_mart(*saved).write.mode("overwrite").parquet(f"{out}/mart_global_commodity_market")
    return spark.read.parquet(f"{out}/mart_global_commodity_market")


# --- E02 candles and E03 live sales ----------------------------------------------------------


def run_candles(trades: DataFrame, out: str, checkpoint: str, widths: Sequence[int] = (5, 15, 45, 60)) -> DataFrame:
    """A stream of raw trade JSON (``raw``, ``tick_id``) to a tick table and 1-minute candles at the same time, and wider candles.

    Candles keep the edge ticks, so a later batch with earlier ticks still gives the right open.
    """
    spark = trades.sparkSession
    ticks = clean.parse_trades(trades, "raw").where("price > 0 AND symbol IS NOT NULL")
    ticks = ticks.withWatermark("event_ts", "10 seconds")
    edge = F.struct("event_ts", "tick_id", "price")
    minute = ticks.groupBy(F.window("event_ts", "1 minute").alias("_w"), "symbol").agg(
        F.min(edge).alias("first"), F.max(edge).alias("last"), F.max("price").alias("high"), F.min("price").alias("low"))
    minute = minute.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "symbol", "first", "last", "high", "low")
    rules = {"first": "least", "last": "greatest", "high": "greatest", "low": "least"}
    by = {"day": F.to_date("window_start")}
    upsert = st.upsert_sink(spark, f"{out}/window_1m", ["window_start", "symbol", "day"], by, rules)
    run_together(spark, {"ticks": lambda: st.start_query(ticks, f"{checkpoint}/ticks", "append", write=st.append_sink(f"{out}/ticks")),
                         "candles": lambda: st.start_query(minute, f"{checkpoint}/candles", "update", write=upsert)})
    candles = spark.read.parquet(f"{out}/window_1m").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "symbol", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"))
    wide = None
    for k in widths:
        one = agg.rollup_candles(candles, k).withColumn("minutes", F.lit(k))
        wide = one if wide is None else wide.unionByName(one)
    return wide


def run_live_sales(sales: DataFrame, out: str, checkpoint: str, processed_at: datetime | None = None) -> DataFrame:
    """A stream of sales (event_timestamp text, kafka_timestamp) to 5-minute metrics per category in a keyed table."""
    spark = sales.sparkSession
    at = F.try_to_timestamp("event_timestamp", F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    timed = st.with_event_time(sales, at, "10 minutes")
    timed = timed.withColumn("processing_delay_seconds", clean.delay_seconds(F.col("kafka_timestamp"), F.col("event_time")))
    write = st.upsert_sink(spark, f"{out}/sales_metrics", ["window_start", "category", "day"], {"day": F.to_date("window_start")},
                           processed_at=processed_at, stamp=True)
    st.start_query(st.sales_metrics(timed), checkpoint, "update", write=st.retrying(write, f"{out}/dlq", reraise=True)).awaitTermination()
    return spark.read.parquet(f"{out}/sales_metrics").drop("day")


# --- E04 monthly sales -----------------------------------------------------------------------


def enrich_monthly(monthly: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Rank of the region within category and month, and cumulative revenue of the region."""
    ranked = windows.rank_in_group(monthly, ["category", "year", "month"], "total_revenue", "region_rank", max_group_rows=max_group_rows)
    total = windows.running_total(ranked, ["region"], ["year", "month", "category"], F.col("total_revenue"),
                                  "cumulative_revenue", max_group_rows)
    return total.withColumn("cumulative_revenue", F.col("cumulative_revenue").cast("double"))


def run_monthly_sales(sales: DataFrame, out: str) -> DataFrame:
    """Typed sales to the enriched monthly table, partitioned by year and month."""
    dated = cols.derive_date_parts(sales, "date")
    monthly = stage(agg.monthly_sales(dated), "monthly")
    files.write_partitioned(enrich_monthly(monthly), out, ["year", "month"])
    return sales.sparkSession.read.parquet(out)


# --- E05 bronze to silver, medallion ---------------------------------------------------------

ORDER_COLUMNS = ("order_id", "customer_id", "order_date", "amount", "status", "product_category", "region")


def bronze_to_silver(spark: SparkSession, landed: str, out: str, max_bad_share: float = 0.5) -> DataFrame:
    """Landed CSV to Parquet: required columns, rows without ids dropped, copies removed,
    amount and date coerced; refuses the file when too many amounts are unreadable."""
    raw = files.read_csv_required(spark, landed, ORDER_COLUMNS)
    kept = raw.dropna(subset=["order_id", "customer_id"]).distinct()
    typed = cols.safe_cast(kept, {"amount": "double", "order_date": "timestamp_ntz"})
    quality.enforce(typed, [quality.max_null_ratio("amount", max_bad_share)])
    typed.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def medallion(spark: SparkSession, bronze: DataFrame, lake: str, inserted_at: datetime) -> DataFrame:
    """Raw orders to bronze, cleaned silver and daily gold revenue; bad rows go to the quarantine."""
    bronze.write.mode("overwrite").parquet(f"{lake}/bronze")
    silver = clean.standardise_orders(spark.read.parquet(f"{lake}/bronze").distinct(), inserted_at)
    rules = [quality.not_null("order_date"), quality.not_null("total"), quality.in_range("total", low=0)]
    checked = stage(quality.with_errors(silver, rules), "silver")
    good = sinks.quarantine(checked, f"{lake}/quarantine", inserted_at.date().isoformat())
    good.write.mode("overwrite").parquet(f"{lake}/silver")
    agg.daily_revenue(spark.read.parquet(f"{lake}/silver"), "order_date", "total").write.mode("overwrite").parquet(f"{lake}/gold")
    return spark.read.parquet(f"{lake}/gold")


# --- E06 and E07 metal prices ----------------------------------------------------------------

# Fields of a quote and numbers of the metals.
QUOTE_FIELDS = ("timestamp", "metal", "currency", "exchange", "symbol", "price_usd", "price_idr", "prev_close_price",
                "open_price", "high_price", "low_price", "ch", "chp", "ingestion_times")
METAL_IDS = {"gold": 1, "silver": 2, "platinum": 3, "palladium": 4, "copper": 5, "aluminum": 6, "lead": 7, "nickel": 8, "zinc": 9}


def metal_quotes(quotes: DataFrame, idr_rate: float, ingested_at: datetime) -> DataFrame:
    """Quotes with epoch time to typed rows with a rupiah price; refuses missing fields and prices <= 0."""
    typed = quotes.withColumns({
        "timestamp": F.timestamp_seconds("timestamp").cast("timestamp_ntz"), "price_usd": F.col("price"),
        "price_idr": F.col("price") * idr_rate, "ingestion_times": F.lit(ingested_at).cast("timestamp_ntz")}).select(*QUOTE_FIELDS)
    rules = [quality.not_null(c) for c in QUOTE_FIELDS] + [quality.in_range("price_usd", low=0, strict=True)]
    return quality.enforce(typed, rules)


def metal_facts(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Payloads (timestamps, unit, metals map, currencies map) to price facts and currency rate facts."""
    prices = reshape.explode_entries(payloads.select(F.col("timestamps.metal").alias("date"), "unit", "metals"), "metals", "metal", "price_usd")
    known = prices.where(F.col("metal").isin(*METAL_IDS))
    fact = known.select(F.sha2(F.concat_ws("|", "metal", "date"), 256).alias("id"), "date",
                        joins.map_lookup(F.col("metal"), METAL_IDS).alias("metal_id"), "unit", "price_usd")
    rates = reshape.explode_entries(payloads.select(F.col("timestamps.currency").alias("date"), "currencies"), "currencies", "currency_code", "rate_to_usd")
    return fact, rates


# --- E08 to E12 ------------------------------------------------------------------------------


def weather_report(raw: DataFrame, report_date: date) -> DataFrame:
    """Weather JSON per city (city, raw) to daily averages and the most recent label per city."""
    typed = clean.extract_weather(raw, "raw")
    staged = cols.rename_columns(typed, {"city": "city", "temperature_2m": "temp", "relative_humidity_2m": "humidity", "time": "updated_at", "weather": "weather"})
    staged = staged.where("temp IS NOT NULL")
    return staged.groupBy("city").agg(
        agg.exact_avg("temp").alias("avg_temp"), agg.exact_avg("humidity").alias("avg_humidity"),
        F.max_by("weather", F.struct("updated_at", "weather")).alias("last_weather")).withColumn("report_date", F.lit(report_date))


def price_alert_job(batch: DataFrame, table: DataFrame, as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """New prices (symbol, price, volume, timestamp, tick_id) against the loaded table.

    Returns the alerts and a one-row summary: extracted, transformed, loaded, alerts.
    """
    checked = batch.withColumn("errors", clean.tick_errors(as_of, min_symbol=1))
    good, _bad = quality.split_valid(checked)
    good = stage(good.withColumn("symbol", F.upper("symbol")), "ticks")
    new = stage(upsert.insert_ignore(table, good, ["symbol", "timestamp"], ["tick_id"]), "new")
    history = table.select(*new.columns).withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
    alerts = windows.price_alerts(history, "symbol", ["timestamp", "tick_id"], "price").where("_new").drop("_new")
    counts = [batch.agg(F.count(F.lit(1)).alias("extracted")), good.agg(F.count(F.lit(1)).alias("transformed")),
              new.agg(F.count(F.lit(1)).alias("loaded")), alerts.agg(F.count(F.lit(1)).alias("alerts"))]
    summary = counts[0]
    for c in counts[1:]:
        summary = cols.attach_scalars(summary, c)
    return alerts, summary


def clean_shop_sales(raw: DataFrame) -> DataFrame:
    """Messy sales (user_email, product, amount, quantity, timestamp) to totals per product; unreadable rows are skipped."""
    typed = clean.parse_amounts(raw, "amount", "paid").select(
        clean.clean_email(F.col("user_email")).alias("email"), "product", "paid", "quantity",
        clean.format_instant(F.col("timestamp")).alias("date"), clean.email_errors(F.col("user_email")).alias("errors"))
    # The verdict goes into the sums: as a filter it would be pushed down and parse every text twice.
    good = (F.size("errors") == 0) & F.col("paid").isNotNull() & F.col("date").isNotNull()
    return agg.sales_by_product(typed, "product", "paid", "quantity", good)


def graded_scores(scores: DataFrame, out: str, batch_id: str, processed_at: datetime, fmt: str = "parquet") -> DataFrame:
    """Impute, grade, stamp, validate and export scores (id, name, score, created_at)."""
    filled = cols.impute_mean(scores, "score")
    graded = filled.withColumn("grade", cols.letter_grade(F.col("score")))
    at = F.lit(processed_at).cast("timestamp_ntz")
    ready = stage(cols.add_lineage(graded, batch_id, processed_at=at, source="scores"), "graded")
    quality.enforce(ready, [quality.not_null("score"), quality.not_null("name"), quality.in_range("score", 0, 100),
                            quality.is_in("grade", ["A", "B", "C", "D", "F"])])
    return scores.sparkSession.read.schema(ready.schema).option("header", True).format(fmt).load(files.export(ready, out, fmt))


def contract_batch(batch: DataFrame, contract: str | Mapping, out: str) -> tuple[DataFrame, dict[str, str | None]]:
    """Contract check, integrity gate, fan-out to three places, daily summary per symbol."""
    typed = stage(contracts.enforce_contract(batch, contract), "contract")
    good, _bad = quality.split_valid(typed)
    rules = [quality.in_range("price", low=0, strict=True), quality.min_length("symbol", 1), quality.in_range("volume", low=0)]
    quality.enforce(good, rules)
    places = {"lake": "parquet", "table": "parquet", "warehouse": "json"}
    done = sinks.fan_out(good, {n: (lambda df, n=n, fmt=fmt: files.export(df, f"{out}/{n}", fmt)) for n, fmt in places.items()})
    day = F.timestamp_seconds("event_time").cast("date")
    return agg.trade_summary(batch.sparkSession.read.parquet(f"{out}/lake"), "symbol", "price", F.col("volume"), day), done
