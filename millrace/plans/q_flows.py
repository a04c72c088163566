"""Queries for the end-to-end jobs. Their raw inputs are derived from the tables."""

from datetime import date, datetime

from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.plans import flows
from millrace.plans.q_sources import SALES_SQL, TRADE_V2
from millrace.plans.q_tables import MONTHLY, sales_table
from millrace.plans.registry import query
from millrace.session import scratch_path
from millrace.sources import files

# Which order priority stands in for which commodity.
STAND_INS = {"gold": "1-URGENT", "silver": "2-HIGH", "platinum": "3-MEDIUM", "nickel": "4-NOT SPECIFIED", "copper": "5-LOW"}


def commodity_documents(t):
    """One nested raw record per order day."""
    per = {c: F.col("o_orderpriority") == p for c, p in STAND_INS.items()}
    top = F.max("o_totalprice")
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        top.alias("m"), F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.max(F.when(cond, F.col("o_totalprice"))), top).alias(c) for c, cond in per.items()],
        *[F.count_if(cond).alias(f"{c}_n") for c, cond in per.items()])
    at, day = F.date_format("d", "yyyy-MM-dd'T'10:00:00"), F.date_format("d", "yyyy-MM-dd")

    def observations(*values):
        return F.struct(F.array(*[F.struct(day.alias("date"), v.alias("value")) for v in values]).alias("observations"))

    dom = F.dayofmonth("d")
    empty = F.struct(F.array().cast("array<struct<date:string,value:string>>").alias("observations"))
    macro = F.to_json(F.create_map(
        F.lit("CPIAUCSL"), F.when(dom == 1, observations(F.col("m").cast("string"))).otherwise(empty),
        F.lit("DTWEXBGS"), F.when(dom == 5, observations((F.col("m") / 2).cast("string"), F.col("m").cast("string")))
        .when(dom == 20, observations(F.lit("."))).otherwise(empty),
        F.lit("DGS10"), F.when(dom % 10 == 0, observations(F.col("n").cast("string"))).otherwise(empty),
        F.lit("OTHER"), observations(F.lit("1"))))
    rates = F.struct((15000 + F.col("n") * 10.0).alias("IDR"), F.lit(0.5).alias("EUR"), (100.0 + F.col("n")).alias("JPY"),
                     F.when(dom % 2 == 1, 7.25).alias("CNY"))
    return d.select(
        at.alias("timestamp"),
        F.struct(F.lit("success").alias("status"), at.alias("timestamp"), F.lit("USD").alias("currency_base"), F.struct(*per).alias("metals")).alias("metals"),
        F.struct(day.alias("date"), F.lit("USD").alias("base"), rates.alias("rates")).alias("currency"), macro.alias("macro"),
        F.struct(at.alias("timestamp"), *[(F.col(f"{c}_n") if c == "gold" else F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_n"))).alias(c) for c in per]).alias("news"))


_DAYS = """d AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS m, count(*) AS n FROM orders GROUP BY 1),
g AS (SELECT d.date, c.commodity_id, coalesce(max(o_totalprice) FILTER (o_orderpriority = c.priority), any_value(d.m)) AS price, any_value(d.n) AS n,
  count(*) FILTER (o_orderpriority = c.priority) AS c FROM orders JOIN d ON CAST(o_orderdate AS DATE) = d.date,
  (VALUES """ + ", ".join(f"('{c}', '{p}')" for c, p in STAND_INS.items()) + ") c(commodity_id, priority) GROUP BY 1, 2)"


@query("e01_commodity_mart", f"""
WITH {_DAYS},
cpi AS (SELECT date AS cpi_date, m AS cpi_value FROM d WHERE day(date) = 1),
usd AS (SELECT date AS usd_index_date, m / 2 AS usd_index_value FROM d WHERE day(date) = 5),
ty AS (SELECT date AS treasury_yield_date, CAST(n AS DOUBLE) AS treasury_yield_value FROM d WHERE day(date) % 10 = 0)
SELECT date, commodity_id, price, CASE WHEN c > 0 OR commodity_id = 'gold' THEN c END AS news_count, price * (15000 + n * 10) AS idr_price, price * (100 + n) AS jpy_price,
  CASE WHEN day(date) % 2 = 1 THEN price * 7.25 END AS cny_price, price * 0.5 AS eur_price, cpi_value, cpi_date, usd_index_value, usd_index_date, treasury_yield_value, treasury_yield_date
FROM g ASOF LEFT JOIN cpi ON date >= cpi_date ASOF LEFT JOIN usd ON date >= usd_index_date ASOF LEFT JOIN ty ON date >= treasury_yield_date
""")
def _(t):
    raw, out = scratch_path(t.spark, "commodity-raw"), scratch_path(t.spark, "commodity")
    files.write_ndjson(commodity_documents(t), raw)
    return flows.run_commodity_mart(t.spark, raw, out)


@query("e02_crypto_candles", """
WITH c AS (SELECT date_trunc('minute', ts) AS window_start, event_type AS symbol, arg_min(value, ROW(date_trunc('second', ts), event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, ROW(date_trunc('second', ts), event_id)) AS close FROM events WHERE value > 0 GROUP BY ALL)
SELECT date_trunc('hour', window_start) + to_minutes(CAST(floor(minute(window_start) / k) * k AS BIGINT)) AS time, symbol, arg_min(open, window_start) AS open, max(high) AS high, min(low) AS low,
  arg_max(close, window_start) AS close, k AS minutes FROM c, (VALUES (5), (15), (45), (60)) w(k) GROUP BY ALL
""")
def _(t):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    trade = F.to_json(F.struct(F.col("event_type").alias("s"), F.col("value").cast("string").alias("p"), millis.alias("T")))
    trades = t.stream("events").select(trade.alias("raw"), F.col("event_id").alias("tick_id"))
    return flows.run_candles(trades, scratch_path(t.spark, "candles"), scratch_path(t.spark, "offsets"))


@query("e03_live_sales_metrics", f"SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS processed_at FROM ({SALES_SQL})")
def _(t):
    ts = F.col("ts").cast("timestamp")
    sales = t.stream("events").select(
        F.col("event_id").cast("string").alias("transaction_id"), F.col("event_type").alias("category"), F.col("value").alias("amount"),
        F.from_json("props", "k int")["k"].alias("quantity"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.timestamp_micros(F.unix_micros(ts) + F.col("event_id") % 300 * 1_000_000).alias("kafka_timestamp"))
    out = flows.run_live_sales(sales, scratch_path(t.spark, "sales"), scratch_path(t.spark, "offsets"), datetime(2024, 2, 1)).drop("batch_id")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end", "processed_at")})


@query("e04_monthly_sales", f"""
WITH {MONTHLY} SELECT *, rank() OVER (PARTITION BY category, year, month ORDER BY total_revenue DESC) AS region_rank,
  EXACT_SUM(total_revenue) OVER (PARTITION BY region ORDER BY year, month, category ROWS UNBOUNDED PRECEDING) AS cumulative_revenue FROM monthly
""")
def _(t):
    landed = scratch_path(t.spark, "sales-csv")
    sales = sales_table(t).drop("year", "month").withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    sales.write.option("header", True).csv(landed)
    typed = files.read_csv_typed(t.spark, landed, sales.schema)
    return flows.run_monthly_sales(typed, scratch_path(t.spark, "monthly"))


@query("e05_bronze_to_silver", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderdate END AS order_date,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS amount, o_orderstatus AS status, o_orderpriority AS product_category, 'R' || o_custkey % 5 AS region FROM orders WHERE o_orderkey % 11 <> 0
""")
def _(t):
    k = F.col("o_orderkey")
    messy = t.orders.select(
        F.when(k % 11 != 0, k).cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(k % 8 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
        F.when(k % 3 == 0, "?").otherwise(F.col("o_totalprice").cast("string")).alias("amount"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("product_category"), F.concat(F.lit("R"), F.col("o_custkey") % 5).alias("region"))
    landed = files.export(messy.unionByName(messy.where("status = 'F'")), scratch_path(t.spark, "landed"), "csv")
    return flows.bronze_to_silver(t.spark, landed, scratch_path(t.spark, "silver"))


@query("e06_metal_price_job", """
SELECT to_timestamp(1700000000 + p_partkey)::TIMESTAMP AS timestamp, 'XAU' AS metal, 'USD' AS currency, 'FOREXCOM' AS exchange, p_brand AS symbol, p_retailprice AS price_usd, p_retailprice * 16000 AS price_idr,
  p_retailprice - 1 AS prev_close_price, p_retailprice - 0.5 AS open_price, p_retailprice + 2 AS high_price, p_retailprice - 2 AS low_price, 1.0::DOUBLE AS ch, 1 / p_retailprice * 100 AS chp,
  TIMESTAMP '2024-02-01 00:00:00' AS ingestion_times FROM part
""")
def _(t):
    p = F.col("p_retailprice")
    quotes = t.part.select(
        (1700000000 + F.col("p_partkey")).alias("timestamp"), F.lit("XAU").alias("metal"), F.lit("USD").alias("currency"), F.lit("FOREXCOM").alias("exchange"),
        F.col("p_brand").alias("symbol"), p.alias("price"), (p - 1).alias("prev_close_price"), (p - 0.5).alias("open_price"), (p + 2).alias("high_price"),
        (p - 2).alias("low_price"), F.lit(1.0).alias("ch"), (1 / p * 100).alias("chp"))
    return flows.metal_quotes(quotes, 16000.0, datetime(2024, 2, 1))


def _payloads(t):
    k, bal = F.col("s_suppkey"), F.col("s_acctbal")
    day = F.concat(F.lit("day-"), k)
    return t.supplier.select(
        F.struct(day.alias("metal"), day.alias("currency")).alias("timestamps"), F.lit("toz").alias("unit"),
        F.create_map(F.lit("gold"), bal, F.lit("zinc"), bal + 1, F.lit("unobtainium"), bal + 2).alias("metals"),
        F.create_map(F.lit("IDR"), bal / 10, F.lit("EUR"), bal / 20).alias("currencies"))


@query("e07_fact_metal_price", """
SELECT sha256(m || '|day-' || s_suppkey) AS id, 'day-' || s_suppkey AS date, i AS metal_id, 'toz' AS unit, s_acctbal + a AS price_usd FROM supplier, (VALUES ('gold', 1, 0), ('zinc', 9, 1)) v(m, i, a)
""")
def _(t):
    return flows.metal_facts(_payloads(t))[0]


@query("e07_fact_currency_rates", "SELECT 'day-' || s_suppkey AS date, c AS currency_code, s_acctbal / f AS rate_to_usd FROM supplier, (VALUES ('IDR', 10), ('EUR', 20)) v(c, f)")
def _(t):
    return flows.metal_facts(_payloads(t))[1]


@query("e08_weather_report", """
WITH w AS (SELECT 'city' || user_id % 20 AS city, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS time, CASE WHEN event_id % 50 <> 0 THEN value END AS temp, CAST(json_extract(props, '$.k') AS DOUBLE) AS hum,
  CASE WHEN event_id % 3 = 0 THEN 'Cerah' WHEN event_id % 3 = 1 THEN 'Kabut' ELSE 'Badai Petir' END AS label FROM events)
SELECT city, EXACT_SUM(temp) / count(temp) AS avg_temp, EXACT_SUM(hum) / count(hum) AS avg_humidity,
  arg_max(label, ROW(time, label)) AS last_weather, DATE '2024-01-31' AS report_date FROM w WHERE temp IS NOT NULL GROUP BY 1
""")
def _(t):
    code = F.element_at(F.array(F.lit(0), F.lit(45), F.lit(95)), (F.col("event_id") % 3 + 1).cast("int"))
    now = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"), F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("temperature_2m"),
                   F.lit(0.5).alias("precipitation"), F.from_json("props", "k double")["k"].alias("relative_humidity_2m"), code.alias("weather_code"))
    raw = t.events.select(F.concat(F.lit("city"), F.col("user_id") % 20).alias("city"), F.to_json(F.struct(now.alias("current"))).alias("raw"))
    return flows.weather_report(raw, date(2024, 1, 31))


def _price_batches(t):
    ticks = t.events.select(F.col("event_type").alias("symbol"), (F.col("value") - 5).alias("price"), F.lit(0.0).alias("volume"), F.col("ts").alias("timestamp"), F.col("event_id").alias("tick_id"))
    table = ticks.where("price > 0 AND timestamp < '2024-01-16'").withColumn("symbol", F.upper("symbol"))
    return ticks.where("timestamp >= '2024-01-10'"), table


_E09 = """
b AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10'), g AS (SELECT * FROM b WHERE value - 5 > 0),
n AS (SELECT upper(event_type) AS symbol, ts, min(event_id) AS event_id FROM g GROUP BY ALL HAVING (upper(event_type), ts) NOT IN (SELECT (upper(event_type), ts) FROM events WHERE ts < TIMESTAMP '2024-01-16' AND value - 5 > 0)),
h AS (SELECT symbol, ts, event_id, true AS fresh FROM n UNION ALL SELECT upper(event_type), ts, event_id, false FROM events WHERE ts < TIMESTAMP '2024-01-16' AND value - 5 > 0),
p AS (SELECT h.symbol, h.ts, h.event_id, fresh, value - 5 AS price, lag(value - 5) OVER (PARTITION BY h.symbol ORDER BY h.ts, h.event_id) AS prev FROM h JOIN events e ON e.event_id = h.event_id),
a AS (SELECT symbol, ts AS timestamp, event_id AS tick_id, price, prev AS previous_price, CASE WHEN abs((price - prev) / prev) >= 0.2 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM p WHERE fresh AND abs((price - prev) / prev) >= 0.1)
"""


@query("e09_price_alerts", f"WITH {_E09} SELECT * FROM a")
def _(t):
    batch, table = _price_batches(t)
    alerts, _summary = flows.price_alert_job(batch, table, datetime(2024, 2, 1))
    return alerts.select("symbol", "timestamp", "tick_id", "price", "previous_price", "severity")


@query("e09_price_summary", f"WITH {_E09} SELECT (SELECT count(*) FROM b) AS extracted, (SELECT count(*) FROM g) AS transformed, (SELECT count(*) FROM n) AS loaded, (SELECT count(*) FROM a) AS alerts")
def _(t):
    batch, table = _price_batches(t)
    return flows.price_alert_job(batch, table, datetime(2024, 2, 1))[1]


@query("e10_shop_sales_cleaning", """
SELECT p_name AS product, EXACT_SUM(l_extendedprice * CASE WHEN l_linenumber <> 2 THEN l_quantity ELSE 1 END) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey % 9 <> 0 AND l_linenumber <> 4 AND l_linenumber <> 5 GROUP BY 1
""")
def _(t):
    n = F.col("l_linenumber")
    raw = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(F.col("l_suppkey") % 9 == 0, "no-at-sign").otherwise(F.concat(F.lit("  User"), "l_suppkey", F.lit("@Shop.COM "))).alias("user_email"),
        F.col("p_name").alias("product"), F.when(n == 4, "free").otherwise(F.concat(F.lit("$"), F.col("l_extendedprice").cast("string"))).alias("amount"),
        F.when(n != 2, F.col("l_quantity")).alias("quantity"),
        F.when(n == 5, "someday").when(n == 1, F.unix_millis(F.col("l_shipdate").cast("timestamp")).cast("string"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamp"))
    return flows.clean_shop_sales(raw)


@query("e11_graded_scores", """
WITH s AS (SELECT event_id AS id, event_type AS name, CASE WHEN event_id % 10 <> 0 THEN least(value / 5, 100.0) END AS score, ts AS created_at FROM events),
m AS (SELECT EXACT_SUM(score) / count(score) AS mean FROM s), f AS (SELECT id, name, coalesce(score, (SELECT mean FROM m)) AS score, created_at FROM s)
SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade, 'b7' AS batch_id, '1.0.0' AS pipeline_version,
  'scores' AS source_name, TIMESTAMP '2024-02-01 00:00:00' AS processed_at FROM f
""")
def _(t):
    scores = t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("name"),
                             F.when(F.col("event_id") % 10 != 0, F.least(F.col("value") / 5, F.lit(100.0))).alias("score"), F.col("ts").alias("created_at"))
    return flows.graded_scores(scores, scratch_path(t.spark, "graded"), "b7", datetime(2024, 2, 1))


@query("e12_contract_batch", """
SELECT event_type AS symbol, CAST(ts AS DATE) AS batch_date, EXACT_SUM(value + 1) / count(*) AS avg_price, min(value + 1) AS min_price, max(value + 1) AS max_price,
  CAST(sum(CAST(json_extract(props, '$.k') AS DOUBLE)) AS DOUBLE) AS total_quantity, count(*) AS trade_count FROM events WHERE event_id % 20 <> 0 GROUP BY 1, 2
""")
def _(t):
    batch = t.events.select(F.col("event_type").alias("symbol"), F.when(F.col("event_id") % 20 == 0, "n/a").otherwise((F.col("value") + 1).cast("string")).alias("price"),
                            F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_time"), F.from_json("props", "k float")["k"].alias("volume"))
    return flows.contract_batch(batch, TRADE_V2, scratch_path(t.spark, "contract"))[0]
