"""Queries for sources, sinks, upserts, dimensions, streams, functions, ML and graph."""

import math
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.functions import udfs
from millrace.operators import aggregates as agg
from millrace.operators import dimensional as dims
from millrace.operators.columns import attach_scalars
from millrace.operators import graph, ml, quality, upsert, windows
from millrace.plans.q_tables import CANDLES, minute_candles, sales_table
from millrace.plans.registry import query
from millrace.session import TABLES, scratch_path, stage
from millrace.sources import contracts, evolution, files, generate, html, kafka, sinks
from millrace.sources.versions import VersionedTable, incremental_model
from millrace.streaming import core as st
from millrace.streaming import lifecycle, sessions, timers

# --- sources and sinks -------------------------------------------------------------------


@query("f01_read_csv_typed", "SELECT * FROM customer")
def _(t):
    path = scratch_path(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return files.read_csv_typed(t.spark, path, t.customer.schema)


@query("f02_read_csv_required", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def _(t):
    path = files.export(t.supplier, scratch_path(t.spark, "csv"), "csv")
    return files.read_csv_required(t.spark, path, ["s_suppkey", "s_name"]).select("s_suppkey", "s_name")


@query("f03_read_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _(t):
    path = scratch_path(t.spark, "ndjson")
    files.write_ndjson(t.events.select("event_id", "value", F.from_json("props", "k int").alias("props")), path)
    return files.read_json(t.spark, path, "event_id bigint, props struct<k:int>").select("event_id", "props.k")


@query("f04_read_parquet", """
SELECT 'region' AS name, count(*) AS rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'conversations', count(*) FROM conversations
UNION ALL SELECT 'benchmark', count(*) FROM benchmark UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part
UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'labels', count(*) FROM labels
""")
def _(t):
    out = None
    for name in TABLES:
        one = files.read_parquet(t.spark, t.path(name)).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("f04_merge_schema", "SELECT s_suppkey, s_name, CASE WHEN s_nationkey >= 12 THEN s_acctbal END AS s_acctbal FROM supplier")
def _(t):
    path = scratch_path(t.spark, "versions")
    t.supplier.where("s_nationkey < 12").select("s_suppkey", "s_name").write.parquet(f"{path}/v=1")
    t.supplier.where("s_nationkey >= 12").select("s_suppkey", "s_name", "s_acctbal").write.parquet(f"{path}/v=2")
    return files.read_parquet(t.spark, path, merge_schema=True).drop("v")


@query("f05_write_ndjson", "SELECT '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS value FROM region")
def _(t):
    path = scratch_path(t.spark, "ndjson")
    files.write_ndjson(t.region, path)
    return t.spark.read.text(path)


@query("f06_write_partitioned", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def _(t):
    path = scratch_path(t.spark, "partitioned")
    files.write_partitioned(t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")),
                            path, ["year", "month"])
    return files.read_parquet(t.spark, path)


@query("f07_compact", "SELECT l_returnflag, count(*) AS rows FROM lineitem GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "compact")
    files.compact(t.lineitem, path)
    return files.read_parquet(t.spark, path).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@query("f08_export_formats", "SELECT fmt, count(*) AS rows, EXACT_SUM(s_acctbal) AS total FROM supplier, (VALUES ('parquet'), ('csv'), ('json')) f(fmt) GROUP BY 1")
def _(t):
    out = None
    for fmt in ("parquet", "csv", "json"):
        path = files.export(t.supplier, scratch_path(t.spark, fmt), fmt)
        back = t.spark.read.schema(t.supplier.schema).option("header", True).format(fmt).load(path)
        one = back.agg(F.lit(fmt).alias("fmt"), F.count(F.lit(1)).alias("rows"), agg.exact_sum("s_acctbal").alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


@query("f10_parse_broker_json", "SELECT event_type AS kind, value AS amount, ts AS kafka_timestamp FROM events")
def _(t):
    body = F.to_json(F.struct(F.col("event_type").alias("kind"), F.col("value").alias("amount"), F.lit("x").alias("unknown")))
    raw = t.events.select(body.cast("binary").alias("value"), F.col("ts").alias("timestamp"))
    return kafka.parse_json_value(raw, "kind string, amount double")


TRADE_V2 = """{"type": "record", "name": "Trade", "fields": [
  {"name": "symbol", "type": "string"}, {"name": "price", "type": "double"}, {"name": "event_time", "type": "long"},
  {"name": "volume", "type": "float", "default": 0.0}]}"""


@query("f12_enforce_contract", """
SELECT event_type AS symbol, TRY_CAST(CASE WHEN event_id % 20 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS price, epoch_us(ts) // 1000000 AS event_time,
  CAST(0 AS FLOAT) AS volume, CASE WHEN event_id % 20 = 0 THEN 'price: wrong type' ELSE '' END AS errors FROM events
""")
def _(t):
    v1 = t.events.select(F.col("event_type").alias("symbol"), F.when(F.col("event_id") % 20 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("price"),
                         F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_time"), F.col("props").alias("extra"))
    return contracts.enforce_contract(v1, TRADE_V2).withColumn("errors", F.array_join("errors", "; "))


@query("f13_json_file_stream", "SELECT event_id, event_type, value FROM events")
def _(t):
    """The table as eight JSON files, two a batch."""
    landed, path = scratch_path(t.spark, "landed"), scratch_path(t.spark, "rows")
    t.events.select("event_id", "event_type", "value").repartition(8).write.json(landed)
    live = generate.json_file_stream(t.spark, landed, "event_id bigint, event_type string, value double", max_files=2)
    st.start_query(live, scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).drop("batch_id")


@query("f14_rate_stream", "SELECT event_id, event_type, CAST(event_id % 10 AS INTEGER) AS value_bucket FROM events")
def _(t):
    """A replayable rate source as the clock that plays the events back by their ids."""
    path, last = scratch_path(t.spark, "rows"), t.events.agg(F.max("event_id")).first()[0] or 0
    ticks = generate.rate_stream(t.spark, last + 1, start_ms=0)
    live = ticks.join(t.events.select("event_id", "event_type"), F.col("value") == F.col("event_id")).select("event_id", "event_type", "value_bucket")
    st.start_query(live, scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).drop("batch_id")


@query("f15_generate_sales", "SELECT count(*) AS sales, count(*) AS ids, 0::bigint AS broken, count(*) AS again FROM orders")
def _(t):
    """As many sales as there are orders: each within the promised ranges, and the same when generated again."""
    n = t.orders.count()
    sales = generate.generate_sales(t.spark, n, seed=7)
    kept = (F.col("amount").between(10, 1000) & F.col("quantity").between(1, 9) & F.col("date").between("2024-01-01", "2024-12-31")
            & F.col("category").isin(*generate.CATEGORIES) & F.col("region").isin(*generate.REGIONS)
            & ((F.col("late_seconds") == 0) | F.col("late_seconds").between(120, 480)))
    one = sales.agg(F.count(F.lit(1)).alias("sales"), F.countDistinct("transaction_id").alias("ids"), F.count_if(~kept).alias("broken"))
    same = sales.join(generate.generate_sales(t.spark, n, seed=7), sales.columns).agg(F.count(F.lit(1)).alias("again"))
    return attach_scalars(one, same)


@query("f16_write_disposition", """
SELECT 'TRUNCATE' AS mode, count(*) AS rows FROM nation UNION ALL SELECT 'APPEND', 2 * count(*) FROM nation UNION ALL SELECT 'EMPTY', count(*) FROM nation
""")
def _(t):
    out = None
    for mode, loads in (("TRUNCATE", 2), ("APPEND", 2), ("EMPTY", 1)):
        path = scratch_path(t.spark, mode.lower())
        for _i in range(loads):
            files.load_with_disposition(t.nation, path, mode)
        one = files.read_parquet(t.spark, path).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


# The metal dimension.
METALS = ((1, "Gold", "Au"), (2, "Silver", "Ag"), (3, "Platinum", "Pt"), (4, "Palladium", "Pd"), (5, "Copper", "Cu"),
          (6, "Aluminium", "Al"), (7, "Lead", "Pb"), (8, "Nickel", "Ni"), (9, "Zinc", "Zn"))


@query("f17_seed_table", "SELECT metal_id, metal_name, symbol, count(p_partkey) AS parts FROM (VALUES "
       + ", ".join(map(str, METALS)) + ") m(metal_id, metal_name, symbol) LEFT JOIN part ON p_size % 10 = metal_id GROUP BY ALL")
def _(t):
    metals = files.seed_table(t.spark, METALS, "metal_id int, metal_name string, symbol string")
    sizes = t.part.groupBy((F.col("p_size") % 10).alias("metal_id")).agg(F.count(F.lit(1)).alias("parts"))
    return metals.join(sizes, "metal_id", "left").fillna(0, ["parts"])


@query("f18_new_files_only", "SELECT c_mktsegment, count(*) AS rows FROM customer GROUP BY 1")
def _(t):
    source, out, ledger = (scratch_path(t.spark, n) for n in ("landed", "out", "ledger"))
    for day in ("c_nationkey < 12", "c_nationkey >= 12"):
        t.customer.where(day).write.mode("append").option("header", True).csv(source)
        for _rerun in range(2):
            files.process_new_files(t.spark, source, t.customer.schema, ledger, st.append_sink(out), "csv", {"header": True})
    return t.spark.read.parquet(out).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"))


@query("f20_fan_out", "SELECT sink, count(*) AS rows FROM nation, (VALUES ('a'), ('b')) s(sink) GROUP BY 1 UNION ALL SELECT 'broken', 0")
def _(t):
    a, b = scratch_path(t.spark, "a"), scratch_path(t.spark, "b")

    def broken(df):
        raise OSError("down")

    done = sinks.fan_out(t.nation, {"a": lambda d: d.write.parquet(a), "broken": broken, "b": lambda d: d.write.parquet(b)})
    counts = None
    for name, path in (("a", a), ("b", b)):
        one = t.spark.read.parquet(path).agg(F.lit(name).alias("sink"), F.count(F.lit(1)).alias("rows"))
        counts = one if counts is None else counts.unionByName(one)
    lost = [(n, 0) for n, error in done.items() if error]
    return counts.unionByName(t.spark.createDataFrame(lost, "sink string, rows bigint"))


@query("f21_quarantine", "SELECT CASE WHEN o_totalprice < 1000 OR o_orderkey % 13 = 0 THEN 'quarantine' ELSE 'good' END AS place, count(*) AS rows FROM orders GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "dlq")
    checked = t.orders.withColumn("errors", F.array_compact(F.array(
        F.when(F.col("o_totalprice") < 1000, "too cheap"), F.when(F.col("o_orderkey") % 13 == 0, "unlucky"))))
    good = sinks.quarantine(checked, path, 1)
    n = F.count(F.lit(1)).alias("rows")
    return good.agg(F.lit("good").alias("place"), n).unionByName(t.spark.read.parquet(path).agg(F.lit("quarantine").alias("place"), n))


@query("f23_extract_html_fields", r"""
WITH x AS (SELECT page_id, url, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS t, regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1) AS h FROM pages)
SELECT page_id, url, regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(t, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS title,
  regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS heading FROM x
""")
def _(t):
    return html.extract_html_fields(t.pages)


@query("f24_read_text_lines", "SELECT event_id || ' ' || upper(event_type) || ' ' || user_id AS value FROM events WHERE event_type = 'error'")
def _(t):
    path = scratch_path(t.spark, "log")
    t.events.select(F.concat_ws(" ", "event_id", F.upper("event_type"), "user_id").alias("value")).write.text(path)
    return files.read_text_lines(t.spark, path, "ERROR")


# --- upserts, dimensions, facts ----------------------------------------------------------


@query("u01_upsert_replace", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
""")
def _(t):
    old, new = t.orders.where("o_orderdate < '1998-01-01'"), t.orders.where("o_orderdate >= '1997-01-01'")
    old = old.select("o_orderkey", "o_orderstatus", "o_totalprice")
    batch = new.select("o_orderkey", F.lit("Z").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return upsert.upsert_replace(old, batch.unionByName(batch), ["o_orderkey"], ["o_totalprice"])


@query("u01_upsert_table", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-07-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
""")
def _(t):
    path = scratch_path(t.spark, "table")
    cols = ("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    old = t.orders.where("o_orderdate < '1998-01-01'").select(*cols)
    batch = t.orders.where("o_orderdate >= '1997-07-01'").select(*cols).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for rows in (old, batch, batch):
        upsert.upsert_table(t.spark, path, rows, ["o_orderkey", "year"], ["year"])
    return t.spark.read.parquet(path)


def _half_minutes(t):
    """Two batches that share every candle: the first and the second half of each minute."""
    return t.events.where(F.second("ts") < 30), t.events.where(F.second("ts") >= 30)


@query("u02_upsert_merge", f"WITH {CANDLES} SELECT * FROM candles")
def _(t):
    early, late = _half_minutes(t)
    # Open and close carry their event, so batches may overlap in time and still merge exactly.
    def candles(e):
        return minute_candles_with_edges(e)

    merged = upsert.upsert_merge(candles(early), candles(late), ["window_start", "symbol"],
                                 {"first": "least", "last": "greatest", "high": "greatest", "low": "least"})
    return merged.select("window_start", "window_end", "symbol", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"))


def minute_candles_with_edges(e):
    edge = F.struct("ts", "event_id", F.col("value").alias("price"))
    g = e.groupBy(F.window("ts", "1 minute").alias("_w"), F.col("event_type").alias("symbol")).agg(
        F.min(edge).alias("first"), F.max(edge).alias("last"), F.max("value").alias("high"), F.min("value").alias("low"))
    return g.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "symbol", "first", "last", "high", "low")


@query("u02_upsert_merge_keep_open", """
WITH b AS (SELECT date_trunc('minute', ts) AS window_start, event_type AS symbol, second(ts) >= 30 AS half, arg_min(value, ROW(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, ROW(ts, event_id)) AS close FROM events GROUP BY ALL),
o AS (SELECT * FROM b WHERE NOT half), n AS (SELECT * FROM b WHERE half)
SELECT window_start, symbol, coalesce(o.open, n.open) AS open, greatest(o.high, n.high) AS high, least(o.low, n.low) AS low, coalesce(n.close, o.close) AS close FROM o FULL JOIN n USING (window_start, symbol)
""")
def _(t):
    def candles(e):
        return agg.ohlc(e, "ts", "event_type", "value", "event_id").drop("window_end")

    old, new = map(candles, _half_minutes(t))
    return upsert.upsert_merge(old, new, ["window_start", "symbol"], {"open": "old", "high": "greatest", "low": "least", "close": "new"})


@query("u03_insert_ignore", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey) AS rn FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1998-01-01') x WHERE rn = 1 AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
""")
def _(t):
    old = t.lineitem.where("l_shipdate < '1998-01-01'")
    batch = t.lineitem.where("l_shipdate >= '1998-01-01'")
    return upsert.insert_ignore(old, batch, ["l_orderkey", "l_linenumber"], ["l_extendedprice", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("u04_replace_partition", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows, max(CASE WHEN year(o_orderdate) = 1998 THEN -o_totalprice ELSE o_totalprice END) AS top FROM orders GROUP BY 1
""")
def _(t):
    path = scratch_path(t.spark, "by-year")
    o = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    upsert.replace_partitions(o, path, ["year"])
    for _rerun in range(2):
        upsert.replace_partitions(o.where("year = 1998").withColumn("o_totalprice", -F.col("o_totalprice")), path, ["year"])
    return t.spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.max("o_totalprice").alias("top"))


@query("u05_incremental_append", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE (o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW') OR o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW') - INTERVAL 3 DAY")
def _(t):
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    # Low-priority rows never reached the table: those of its last three days come in late.
    loaded = t.orders.where("o_orderdate < '1997-01-01' AND o_orderpriority <> '5-LOW'").select(*o.columns)
    return upsert.incremental_append(loaded, o, "o_orderdate", ["o_orderkey"], ["o_orderdate"], lookback=timedelta(days=3))


def _two_snapshots(t):
    k = F.col("c_custkey")
    first = t.customer.where("c_nationkey <> 9").select("c_custkey", "c_mktsegment", F.when(k % 6 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    second = t.customer.where("c_nationkey <> 8").select("c_custkey", F.when(k % 4 == 0, "MOVED").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
                                                  F.when(k % 9 != 0, F.when(k % 6 != 0, F.col("c_acctbal"))).alias("c_acctbal"))
    return first, second


@query("u06_scd2", """
WITH a AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_nationkey <> 9),
b AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 9 <> 0 AND c_custkey % 6 <> 0 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_nationkey <> 8),
j AS (SELECT coalesce(a.c_custkey, b.c_custkey) AS k, a.c_custkey IS NOT NULL AS in_a, b.c_custkey IS NOT NULL AS in_b, a.c_mktsegment AS am, a.c_acctbal AS ab, b.c_mktsegment AS bm, b.c_acctbal AS bb,
  a.c_mktsegment IS DISTINCT FROM b.c_mktsegment OR a.c_acctbal IS DISTINCT FROM b.c_acctbal AS diff FROM a FULL JOIN b ON a.c_custkey = b.c_custkey),
v AS (SELECT k, am AS seg, ab AS bal, TIMESTAMP '2024-01-01 00:00:00' AS f, CASE WHEN in_b AND diff THEN TIMESTAMP '2024-02-01 00:00:00' END AS u, NOT (in_b AND diff) AS cur FROM j WHERE in_a
  UNION ALL SELECT k, bm, bb, TIMESTAMP '2024-02-01 00:00:00', NULL, true FROM j WHERE in_b AND (NOT in_a OR diff)),
w AS (SELECT k, seg, bal, f, CASE WHEN cur AND seg = 'BUILDING' THEN TIMESTAMP '2024-03-01 00:00:00' ELSE u END AS u, cur AND seg <> 'BUILDING' AS cur FROM v
  UNION ALL SELECT k, 'AGAIN', bal, TIMESTAMP '2024-03-01 00:00:00', NULL, true FROM v WHERE cur AND seg = 'BUILDING')
SELECT sha256(concat_ws('|', CAST(k AS VARCHAR), CAST(f AS VARCHAR))) AS version_key, k AS c_custkey, seg AS c_mktsegment, bal AS c_acctbal, f AS valid_from, u AS valid_to, cur AS is_current FROM w
""")
def _(t):
    first, second = _two_snapshots(t)
    tracked = ["c_mktsegment", "c_acctbal"]
    dim = dims.scd2_open(first, ["c_custkey"], tracked, datetime(2024, 1, 1))
    dim = dims.scd2(dim, second, ["c_custkey"], tracked, datetime(2024, 2, 1))
    third = dim.where("is_current AND c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("AGAIN").alias("c_mktsegment"), "c_acctbal")
    return dims.scd2(dim, third, ["c_custkey"], tracked, datetime(2024, 3, 1))


@query("u07_scd1", "SELECT s_suppkey, s_name, CASE WHEN s_nationkey >= 15 THEN 0.0 ELSE s_acctbal END AS s_acctbal FROM supplier")
def _(t):
    old = t.supplier.where("s_nationkey < 20").select("s_suppkey", "s_name", "s_acctbal")
    return dims.scd1(old, t.supplier.where("s_nationkey >= 15").select("s_suppkey", "s_name", F.lit(0.0).alias("s_acctbal")), ["s_suppkey"])


@query("u08_dim_from_source", """
SELECT DISTINCT p_type, CASE p_type WHEN 'ECONOMY' THEN 'Economy line' WHEN 'SMALL' THEN 'Small parts' ELSE 'Unknown Series' END AS type_name, 'daily' AS frequency FROM part
""")
def _(t):
    return dims.dim_from_source(t.part, "p_type", {"ECONOMY": "Economy line", "SMALL": "Small parts"}, "type_name", "Unknown Series", {"frequency": "daily"})


@query("u09_surrogate_key", """
SELECT o_orderkey, sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END, '∅'))) AS sk, o_custkey || '-' || CAST(o_orderdate AS DATE) AS ck FROM orders
""")
def _(t):
    o = t.orders.withColumns({"pr": F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")), "day": F.to_date("o_orderdate")})
    return o.select("o_orderkey", dims.surrogate_key(["o_custkey", "pr"]).alias("sk"), dims.composite_key(["o_custkey", "day"]).alias("ck"))


@query("u11_materialise", "SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1")
def _(t):
    staged = dims.materialise(t.supplier.where("s_acctbal IS NOT NULL"), "stg_supplier", "view")
    counted = dims.materialise(staged.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers")), "int_supplier", "ephemeral")
    return counted


def _incremental(t, steps: str):
    """A table of orders kept by an incremental model: orders before 1997, then all; late rows of its last three days come in too."""
    o = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    table = VersionedTable(t.spark, scratch_path(t.spark, "model"))
    before = t.orders.where("o_orderdate < '1997-01-01' AND o_orderpriority <> '5-LOW'").select(*o.columns)
    args = ("o_orderdate", ["o_orderkey"], ["o_orderdate"], timedelta(days=3))
    incremental_model(table, before, *args)
    versions = [incremental_model(table, o, *args) for _ in range(2 if "again" in steps else 1)]
    if "refresh" in steps:
        versions.append(incremental_model(table, o, *args, full_refresh=True))
    return table.read(), versions


@query("u11_incremental_model", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE (o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW') OR o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW') - INTERVAL 3 DAY")
def _(t):
    return _incremental(t, "once")[0]


@query("u11_incremental_again", "SELECT count(*) AS orders, sum(o_orderkey)::bigint AS keys, true AS unchanged FROM orders WHERE (o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW') OR o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' AND o_orderpriority <> '5-LOW') - INTERVAL 3 DAY")
def _(t):
    rows, versions = _incremental(t, "again")
    return rows.agg(F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys"), F.lit(versions == [2, None]).alias("unchanged"))


@query("u11_full_refresh", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def _(t):
    return _incremental(t, "refresh")[0]


def _supplier_files(t):
    """A registered table of two files, the second with another order of columns, a wider key, one more and one column fewer."""
    path, name = scratch_path(t.spark, "supplier"), f"supplier_{uuid.uuid4().hex}"
    half = F.col("s_suppkey") % 2 == 0
    old = t.supplier.where(half).select(F.col("s_suppkey").cast("int").alias("s_suppkey"), "s_name", "s_nationkey")
    new = t.supplier.where(~half).select("s_name", F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_acctbal")
    old.write.parquet(path)
    files.register_table(t.spark, name, path, old.schema)
    new.write.mode("append").parquet(path)
    return name, path, new.schema


SCHEMA_CHANGES = """SELECT c AS column, change, old_type, new_type, verdict, {applied} AS applied, (SELECT count(*) FROM supplier) AS rows FROM (VALUES
  ('s_suppkey', 'widened', 'int', 'bigint', 'safe'), ('s_nationkey', 'dropped', 'int', NULL, 'risky'), ('s_acctbal', 'added', NULL, 'double', 'safe'),
  ('*', 'reordered', 's_suppkey,s_name,s_nationkey', 's_name,s_suppkey,s_acctbal', 'safe')) v(c, change, old_type, new_type, verdict)"""


def _watched(t, policy: str):
    name, path, schema = _supplier_files(t)
    history = scratch_path(t.spark, "history")
    evolution.watch_schema(t.spark, name, path, history, policy, datetime(2024, 1, 31), schema)
    return t.spark.table(name), evolution.schema_history(t.spark, history, name)


@query("f19_schema_update", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS s_nationkey, CASE WHEN s_suppkey % 2 <> 0 THEN s_acctbal END AS s_acctbal FROM supplier")
def _(t):
    return _watched(t, "UPDATE")[0]


@query("f19_schema_log", "SELECT s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS s_nationkey FROM supplier")
def _(t):
    return _watched(t, "LOG")[0].drop("s_suppkey")  # its new files are wider than the entry says


@query("u16_drift_applied", SCHEMA_CHANGES.format(applied="change IN ('added', 'widened')"))
def _(t):
    return attach_scalars(_watched(t, "UPDATE")[1].drop("table_name", "seen_at"), t.supplier.agg(F.count(F.lit(1)).alias("rows")))


@query("u16_drift_logged", SCHEMA_CHANGES.format(applied="false"))
def _(t):
    return attach_scalars(_watched(t, "LOG")[1].drop("table_name", "seen_at"), t.supplier.agg(F.count(F.lit(1)).alias("rows")))


@query("u12_partial_sources", """
SELECT n_nationkey, c.customers, NULL AS news FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey
""")
def _(t):
    c = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    out = dims.join_sections(t.spark, t.nation.select("n_nationkey"), "n_nationkey", {"people": (c, "customers bigint"), "press": (None, "news bigint")})
    return out.select("n_nationkey", "people.customers", "press.news")


@query("u13_medallion_flow", """
WITH d AS (SELECT DISTINCT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0)
SELECT order_date, count(*) AS total_orders, EXACT_SUM(o_totalprice) AS total_revenue, EXACT_SUM(o_totalprice) / count(*) AS avg_order_value FROM d GROUP BY 1
""")
def _(t):
    from millrace.plans.flows import medallion

    s = F.col("o_orderstatus")
    messy = t.orders.select(
        F.concat(F.lit("ORD-"), "o_orderkey").alias("order_id"), F.concat(F.lit(" CUST-"), "o_custkey", F.lit(" ")).alias("customer_id"),
        F.when(F.col("o_orderkey") % 10 == 0, "15.01.24").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("order_date"),
        F.when(s == "F", "Completed").otherwise("open").alias("status"), F.concat(F.lit(" "), F.col("o_totalprice").cast("string")).alias("total"))
    twice = messy.unionByName(messy.where("length(order_id) = 9"))
    return medallion(t.spark, twice, scratch_path(t.spark, "lake"), datetime(2024, 1, 15, 12))


@query("u14_data_vault", """
SELECT 'hub' AS part, sha256(CAST(o_custkey AS VARCHAR)) AS key FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1995-07-01') GROUP BY o_custkey
UNION ALL SELECT 'link', sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR))) FROM orders
UNION ALL SELECT 'satellite', sha256(CAST(o_orderkey AS VARCHAR)) FROM orders WHERE o_orderkey % 2 = 0
""")
def _(t):
    at = datetime(2024, 1, 1)
    old = dims.hub(t.orders.where("o_orderdate < '1995-07-01'"), ["o_custkey"], None, at, "orders")
    new = dims.hub(t.orders, ["o_custkey"], old, at, "orders").select(F.lit("hub").alias("part"), F.col("hub_key").alias("key"))
    pairs = dims.link(t.orders, {"customer_key": ["o_custkey"], "order_key": ["o_orderkey"]}, None, at, "orders").select(F.lit("link").alias("part"), F.col("link_key").alias("key"))
    now = dims.satellite(t.orders, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], None, at)
    changed = t.orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    sat = dims.satellite(changed, ["o_orderkey"], ["o_orderstatus", "o_totalprice"], now, at).select(F.lit("satellite").alias("part"), F.col("hub_key").alias("key"))
    return new.unionByName(pairs).unionByName(sat)


@query("u15_star_schema", """
SELECT o_orderkey, o_totalprice, sha256(CAST(o_custkey AS VARCHAR)) AS customer_key, c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders JOIN customer ON o_custkey = c_custkey
""")
def _(t):
    path = scratch_path(t.spark, "star")
    dim = t.customer.select(dims.surrogate_key(["c_custkey"]).alias("customer_key"), "c_name", "c_mktsegment")
    fact = t.orders.select("o_orderkey", dims.surrogate_key(["o_custkey"]).alias("customer_key"), "o_totalprice", F.year("o_orderdate").alias("year"))
    dims.write_star(fact, {"dim_customer": dim}, path, ["year"])
    back = t.spark.read.parquet(f"{path}/fact").join(t.spark.read.parquet(f"{path}/dim_customer"), "customer_key")
    return back.select("o_orderkey", "o_totalprice", "customer_key", "c_mktsegment", "year")


# --- streams over the tables -------------------------------------------------------------


def event_stream(t, delay="10 minutes"):
    """The events table as a file stream with its event time declared."""
    return st.with_event_time(t.stream("events"), F.col("ts"), delay)


def as_sales(e):
    """Events seen as sales records; the broker time trails the event time by the id's remainder."""
    return e.select(
        F.col("event_id").cast("string").alias("transaction_id"), F.col("event_type").alias("category"), F.col("value").alias("amount"),
        F.from_json("props", "k int")["k"].alias("quantity"), "event_time", (F.col("event_id") % 300).alias("processing_delay_seconds"))


def drain(t, df, keys, mode="update", rules=None):
    """Run a streaming aggregation to the end of its input into a keyed table and read the table."""
    path = scratch_path(t.spark, "stream-table")
    by = {"day": F.to_date("window_start")} if "window_start" in keys else {"bucket": st.bucket_of(keys)}
    write = st.upsert_sink(t.spark, path, [*keys, *by], by, rules)
    st.start_query(df, scratch_path(t.spark, "offsets"), mode, write=write).awaitTermination()
    back = t.spark.read.parquet(path).drop(*by)
    return back.withColumns({c: F.col(c).cast("timestamp_ntz") for c in back.columns if c.startswith("window_")})


@query("s01_event_time", """
WITH h AS (SELECT date_trunc('hour', ts) AS window_start, EXACT_SUM(value) AS total FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, total FROM h WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
""")
def _(t):
    """Hours come out once the watermark, ten minutes behind the newest event, has passed them."""
    path = scratch_path(t.spark, "hours")
    st.start_query(st.hourly_totals(event_stream(t), "event_time", "value"), scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "total")


@query("s12_output_modes", """
SELECT shape, mode, started, CASE WHEN started THEN (SELECT count(*) FROM events) END AS input_rows FROM (VALUES
  ('rows', 'append', true), ('rows', 'update', true), ('rows', 'complete', false), ('totals', 'append', false), ('totals', 'update', true),
  ('totals', 'complete', false), ('hours', 'append', true), ('hours', 'update', true), ('board', 'complete', true), ('rows', 'replace', false)) v(shape, mode, started)
""")
def _(t):
    """What a start allows for plain rows, totals without a watermark, windows with one, and a result of bounded size."""
    shapes = {"rows": event_stream(t).select("event_id"), "totals": st.running_totals(t.stream("events"), "user_id", "value"),
              "hours": st.hourly_totals(event_stream(t), "event_time", "value"), "board": st.leaderboard(t.stream("events"), "user_id", "value")}
    tried = [("rows", "append"), ("rows", "update"), ("rows", "complete"), ("totals", "append"), ("totals", "update"), ("totals", "complete"),
             ("hours", "append"), ("hours", "update"), ("board", "complete"), ("rows", "replace")]
    out = []
    for shape, mode in tried:
        try:
            q = st.start_query(shapes[shape], scratch_path(t.spark, "offsets"), mode, fmt="noop")
        except ValueError:
            out.append((shape, mode, False, None))
            continue
        q.awaitTermination()
        out.append((shape, mode, True, sum(p["numInputRows"] for p in q.recentProgress)))
    return t.spark.createDataFrame(out, "shape string, mode string, started boolean, input_rows long")


@query("s17_rate_limit", "SELECT 6::bigint AS batches, count(*) AS input_rows FROM events")
def _(t):
    """Twelve files, two a batch."""
    path = scratch_path(t.spark, "files")
    t.events.select("event_id").repartition(12).write.parquet(path)
    source = t.spark.readStream.schema("event_id bigint").option("maxFilesPerTrigger", 2).parquet(path)
    with lifecycle.ProgressLog(t.spark, scratch_path(t.spark, "progress")) as log:
        q = st.start_query(source, scratch_path(t.spark, "offsets"), "append", fmt="noop")
        q.awaitTermination()
        rows = log.wait(q).where("input_rows > 0")
    return rows.agg(F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"))


@query("f22_stream_sinks", "SELECT sink, count(*) AS rows FROM events, (VALUES ('parquet'), ('batches'), ('memory'), ('console')) v(sink) GROUP BY 1")
def _(t):
    """The same stream into four sinks; memory and console, which pass through the driver, get one row of counts."""
    path, batches, name = scratch_path(t.spark, "rows"), scratch_path(t.spark, "batches"), f"rows_{uuid.uuid4().hex}"
    live, counted = event_stream(t).select("event_id"), t.stream("events").groupBy().agg(F.count(F.lit(1)).alias("rows"))
    st.start_query(live, scratch_path(t.spark, "offsets"), "append", fmt="parquet", path=path).awaitTermination()
    st.start_query(live, scratch_path(t.spark, "offsets"), "append", write=st.append_sink(batches)).awaitTermination()
    st.start_query(counted, scratch_path(t.spark, "offsets"), "update", fmt="memory", name=name).awaitTermination()
    shown = st.start_query(counted, scratch_path(t.spark, "offsets"), "update", fmt="console")
    shown.awaitTermination()
    parts = [t.spark.read.schema("event_id bigint").parquet(p).agg(F.lit(n).alias("sink"), F.count(F.lit(1)).alias("rows")) for n, p in (("parquet", path), ("batches", batches))]
    parts.append(t.spark.table(name).select(F.lit("memory").alias("sink"), "rows"))
    parts.append(t.spark.createDataFrame([("console", sum(p["numInputRows"] for p in shown.recentProgress))], "sink string, rows long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SALES_SQL = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type AS category,
  EXACT_SUM(value) AS total_sales, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS total_quantity, count(*) AS transaction_count,
  CAST(round(CAST(CAST(EXACT_SUM(value) / count(*) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS avg_transaction_value, max(event_id % 300) AS max_delay_seen FROM events WHERE value > 0 GROUP BY ALL
"""


@query("s02_tumbling_sales_stream", SALES_SQL)
def _(t):
    return drain(t, st.sales_metrics(as_sales(event_stream(t))), ["window_start", "category"])


@query("s02_tumbling_sales_batch", SALES_SQL)
def _(t):
    return st.sales_metrics(as_sales(t.events.withColumn("event_time", F.col("ts"))))


@query("s02_hourly_totals", "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, EXACT_SUM(value) AS total FROM events GROUP BY ALL")
def _(t):
    return st.hourly_totals(t.events, "ts", "value")


SLIDING_SQL = """
WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - s * INTERVAL 5 MINUTE AS window_start, value, event_type FROM events, (VALUES (0), (1)) v(s))
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type, EXACT_SUM(value) / count(*) AS avg_value, count(*) AS rows FROM w GROUP BY ALL
"""


@query("s03_sliding_window", SLIDING_SQL)
def _(t):
    return drain(t, st.sliding_average(event_stream(t), "event_time", "value", "10 minutes", "5 minutes", ["event_type"]), ["window_start", "event_type"])


@query("s04_stream_ohlc", f"WITH {CANDLES} SELECT * FROM candles")
def _(t):
    return drain(t, agg.ohlc(event_stream(t, "10 seconds"), "event_time", "event_type", "value", "event_id"), ["window_start", "symbol"])


@query("s05_session_window", """
WITH f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM f)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end, count(*) AS actions, EXACT_SUM(value) AS total_value FROM s GROUP BY user_id, session_no
""")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    numbered = windows.sessionize(e, ["user_id"], "ts", "event_id", 6 * 3600)
    s = numbered.groupBy("user_id", "session_no").agg(F.min("ts").alias("window_start"), (F.max("ts") + F.expr("INTERVAL 6 HOURS")).alias("window_end"),
                                                      F.count(F.lit(1)).alias("actions"), agg.exact_sum("value").alias("total_value"))
    return s.drop("session_no")


SESSIONS_30 = """
WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM e)
SELECT CAST(user_id AS VARCHAR) AS key, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS actions, EXACT_SUM(value) AS total_value
FROM s GROUP BY user_id, session_no"""


#: Rows of a file that a stream reads, about: one task reads a file.
FILE_ROWS = 250_000


def _streamed_sessions(t):
    """Events in four batches without any order of time, so that later batches lengthen and join sessions of earlier ones. The files of a batch follow its rows."""
    path = scratch_path(t.spark, "files")
    events = t.events.select("event_id", "user_id", "ts", "value")
    files = max(1, math.ceil(events.count() / (4 * FILE_ROWS)))
    events.repartition(4 * files, "event_id").write.parquet(path)
    source = t.spark.readStream.schema("event_id bigint, user_id bigint, ts timestamp_ntz, value double").option("maxFilesPerTrigger", files).parquet(path)
    kept = sessions.Sessions(t.spark, scratch_path(t.spark, "sessions"), "user_id", "ts", "value", delay=timedelta(days=3650))
    st.start_query(source, scratch_path(t.spark, "offsets"), "append", write=kept.write).awaitTermination()
    return kept


@query("s05_stream_sessions", SESSIONS_30)
def _(t):
    return _streamed_sessions(t).current()


@query("s05_session_changes", SESSIONS_30)
def _(t):
    """What all changes leave: each session that was added and not retracted."""
    by = ["key", "window_start", "window_end", "actions", "total_value"]
    left = _streamed_sessions(t).changes().groupBy(*by).agg(F.sum(F.when(F.col("op") == "+", 1).otherwise(-1)).alias("n"))
    return left.where("n = 1").drop("n")


@query("s06_running_totals", "SELECT user_id, EXACT_SUM(value) AS total, count(*) AS rows FROM events GROUP BY 1")
def _(t):
    return drain(t, st.running_totals(event_stream(t), "user_id", "value"), ["user_id"])


@query("s07_stream_distinct")
def _(t):
    return drain(t, st.active_users(event_stream(t), "event_time", "event_type", "user_id", "1 day"), ["window_start", "event_type"])


@query("s08_leaderboard", "SELECT user_id, EXACT_SUM(value) AS total_score FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def _(t):
    st.check_output_mode("complete", aggregated=True, watermarked=False, bounded_result=True)
    path = scratch_path(t.spark, "board")
    st.start_query(st.leaderboard(event_stream(t), "user_id", "value"), scratch_path(t.spark, "offsets"), "complete",
                   write=lambda df, _id: df.write.mode("overwrite").parquet(path)).awaitTermination()
    return t.spark.read.parquet(path)


@query("s09_stream_dedup", "SELECT DISTINCT event_type AS symbol, date_trunc('second', ts) AS second FROM events")
def _(t):
    ticks = t.stream("events").select(
        F.col("event_type").alias("symbol"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("second"))
    once = st.dedup_events(ticks.unionByName(ticks), ["symbol", "second"], "second", "10 seconds")
    path = scratch_path(t.spark, "ticks")
    st.start_query(once, scratch_path(t.spark, "offsets"), "append", fmt="parquet", path=path).awaitTermination()
    return t.spark.read.schema(once.schema).parquet(path).withColumn("second", F.col("second").cast("timestamp_ntz"))


@query("s10_keyed_state", "SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS events, round(sum(value), 2) AS total, max(ts) AS last_seen FROM events GROUP BY 1")
def _(t):
    path = scratch_path(t.spark, "activity")
    st.start_query(st.keyed_activity(t.stream("events"), "user_id", "ts", "value", "10 minutes"), scratch_path(t.spark, "offsets"), "update",
                   write=st.append_sink(path)).awaitTermination()
    # A query over all available input may end with an extra batch in which idle keys expire.
    newest = windows.latest_per_key(t.spark.read.parquet(path).where("NOT expired"), ["key"], ["last_seen", "events"])
    return newest.select("key", "events", F.round("total", 2).alias("total"), F.col("last_seen").cast("timestamp_ntz").alias("last_seen"))


ACTIVE = """SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS events, round(sum(value), 2) AS total, max(ts) AS last_seen,
count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1"""


def _timed_activity(t, source):
    path = scratch_path(t.spark, "activity")
    with timers.rocksdb_state(t.spark):
        st.start_query(timers.activity_on_timers(source, "user_id", "ts", "value", "10 minutes"), scratch_path(t.spark, "offsets"), "update",
                       write=st.append_sink(path)).awaitTermination()
    rows = t.spark.read.parquet(path)
    return rows.select("key", "events", F.round("total", 2).alias("total"), F.col("last_seen").cast("timestamp_ntz").alias("last_seen"), "days", "expired")


@query("s10_state_on_timers", ACTIVE)
def _(t):
    rows = _timed_activity(t, t.stream("events")).where("NOT expired")
    return windows.latest_per_key(rows, ["key"], ["last_seen", "events"]).drop("expired")


@query("s10_timer_expiry", ACTIVE)
def _(t):
    """Every key expires, since one more event, two days after the last, moves the watermark past all timers."""
    e = t.stream("events").select("user_id", "ts", "value")
    end = t.events.agg(F.lit(-1).cast("bigint").alias("user_id"), (F.max("ts") + F.make_dt_interval(days=F.lit(2))).alias("ts"), F.lit(0.0).alias("value"))
    late = t.spark.readStream.schema(end.schema).parquet(files.export(end, scratch_path(t.spark, "end"), "parquet"))
    return _timed_activity(t, e.unionByName(late)).where("expired AND key <> '-1'").drop("expired")


@query("s11_order_payment_stream", """
SELECT event_id AS order_id, ts AS order_time, CASE WHEN event_type <> 'error' AND event_id % 30 <= 15 THEN ts + to_minutes(event_id % 30) END AS payment_time,
  CASE WHEN event_type <> 'error' AND event_id % 30 <= 15 THEN 'completed' ELSE 'failed' END AS status FROM events
""")
def _(t):
    """Paid orders, and those that fail: they come out as the watermark passes them, which one more event after the last one makes sure of."""
    e = t.stream("events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    end = t.events.agg(F.lit(-1).cast("bigint").alias("event_id"), F.lit("end").alias("event_type"), (F.max("ts").cast("timestamp") + F.make_dt_interval(days=F.lit(2))).alias("ts"))
    e = e.unionByName(t.spark.readStream.schema(end.schema).parquet(files.export(end, scratch_path(t.spark, "end"), "parquet")))
    orders = e.select(F.col("event_id").alias("order_id"), F.col("ts").alias("order_time"))
    paid = e.where("event_type <> 'error'").select(F.col("event_id").alias("payment_order_id"), (
        F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 30).cast("int"))).alias("payment_time"))
    path = scratch_path(t.spark, "matched")
    matched = st.match_payments(orders, paid)
    st.start_query(matched, scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).select("order_id", F.col("order_time").cast("timestamp_ntz").alias("order_time"),
                                             F.col("payment_time").cast("timestamp_ntz").alias("payment_time"), "status")


@query("j14_stream_static_join", "SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")
def _(t):
    path = scratch_path(t.spark, "enriched")
    people = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    live = t.stream("events").select("event_id", "user_id").join(people, "user_id", "left")
    st.start_query(live, scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).select("event_id", "user_id", "c_name", "c_mktsegment")


@query("s13_raw_tick_sink", "SELECT event_id, event_type, ts, value FROM events")
def _(t):
    path = scratch_path(t.spark, "raw")
    raw = event_stream(t).select("event_id", "event_type", "event_time", "value")
    st.start_query(raw, scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).select("event_id", "event_type", F.col("event_time").cast("timestamp_ntz").alias("ts"), "value")


@query("s14_upsert_sink_replay", SALES_SQL)
def _(t):
    path = scratch_path(t.spark, "metrics")
    write = st.upsert_sink(t.spark, path, ["window_start", "category", "day"], {"day": F.to_date("window_start")})
    batch = st.sales_metrics(as_sales(t.events.withColumn("event_time", F.col("ts"))))
    for batch_id in (0, 0):
        write(batch, batch_id)
    return t.spark.read.parquet(path).drop("day")


@query("s15_retry_dead_letter", "SELECT count(*) AS parked, 2 AS pauses FROM events")
def _(t):
    path, pauses = scratch_path(t.spark, "dlq"), []

    def broken(batch, batch_id):
        raise OSError("database is down")

    st.start_query(event_stream(t), scratch_path(t.spark, "offsets"), "append",
                   write=st.retrying(broken, path, attempts=3, reraise=False, sleep=pauses.append)).awaitTermination()
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("parked"), F.lit(len(pauses)).alias("pauses"))


@query("s16_restart_from_checkpoint", "SELECT event_type AS symbol, count(*) AS rows, EXACT_SUM(value) AS total FROM events GROUP BY 1")
def _(t):
    landed, offsets, path = (scratch_path(t.spark, n) for n in ("landed", "offsets", "table"))
    schema = "event_type string, value double"
    write = st.upsert_sink(t.spark, path, ["event_type", "bucket"], {"bucket": st.bucket_of(["event_type"])})
    for early in (True, False):
        half = t.events.where(F.col("ts") < "2024-01-15" if early else F.col("ts") >= "2024-01-15")
        half.select("event_type", "value").write.mode("append").json(landed)
        for _restart in range(2):
            totals = st.running_totals(t.spark.readStream.schema(schema).json(landed), "event_type", "value")
            st.start_query(totals, offsets, "update", write=write).awaitTermination()
    return t.spark.read.parquet(path).select(F.col("event_type").alias("symbol"), "rows", "total")


@query("s18_query_health", "SELECT count(*) AS input_rows, false AS any_negative FROM events")
def _(t):
    with lifecycle.ProgressLog(t.spark, scratch_path(t.spark, "progress")) as log:
        q = st.start_query(st.running_totals(event_stream(t), "event_type", "value"), scratch_path(t.spark, "offsets"), "update",
                           write=lambda df, _id: df.write.mode("overwrite").parquet(scratch_path(t.spark, "sink")))
        q.awaitTermination()
        report = lifecycle.health_report(log.wait(q))
    return report.select("input_rows", ((F.col("state_rows") < 0) | (F.col("longest_ms") < 0)).alias("any_negative"))


@query("s18_all_batches", "SELECT 110::bigint AS batches, count(*) AS input_rows, 0::bigint AS missing FROM events")
def _(t):
    """More batches than a query itself remembers: the table in 110 files, one a batch."""
    path = scratch_path(t.spark, "files")
    t.events.select("event_id").repartition(110).write.parquet(path)
    with lifecycle.ProgressLog(t.spark, scratch_path(t.spark, "progress"), every=40) as log:
        source = t.spark.readStream.schema("event_id bigint").option("maxFilesPerTrigger", 1).parquet(path)
        q = st.start_query(source, scratch_path(t.spark, "offsets"), "append", fmt="noop")
        q.awaitTermination()
        rows = log.wait(q).where("input_rows > 0")
    return rows.agg(F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"), (F.max("batch_id") + 1 - F.countDistinct("batch_id")).alias("missing"))


@query("s21_queries_together", "SELECT 'actions' AS name, count(*) AS rows FROM events UNION ALL SELECT 'sales', count(*) FILTER (WHERE event_type = 'purchase') FROM events")
def _(t):
    """Two queries over one source at the same time, until both have ended."""
    paths = {name: scratch_path(t.spark, name) for name in ("actions", "sales")}
    sources = {"actions": event_stream(t), "sales": event_stream(t).where("event_type = 'purchase'")}
    lifecycle.run_together(t.spark, {name: lambda name=name: st.start_query(sources[name], scratch_path(t.spark, "offsets"), "append", write=st.append_sink(paths[name]))
                                     for name in paths})
    parts = [t.spark.read.parquet(p).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows")) for name, p in paths.items()]
    return parts[0].unionByName(parts[1])


@query("s19_content_routing", "SELECT CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'errors' END AS route, count(*) AS rows FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1")
def _(t):
    from millrace.operators.columns import event_pattern

    where = {"orders": event_pattern({"event_type": ["purchase"]}), "errors": event_pattern({"event_type": [{"prefix": "err"}]})}
    paths = {name: scratch_path(t.spark, name) for name in where}
    st.start_query(event_stream(t), scratch_path(t.spark, "offsets"), "append",
                   write=st.route_sink({n: (cond, st.append_sink(paths[n])) for n, cond in where.items()})).awaitTermination()
    out = None
    for name, path in paths.items():
        one = t.spark.read.parquet(path).agg(F.lit(name).alias("route"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


@query("s20_serving_view", "SELECT event_id, ts, value FROM events")
def _(t):
    cutoff = datetime(2024, 1, 20)
    e = t.events.select("event_id", "ts", "value")
    return st.serving_view(e.where("ts < '2024-01-22'"), e.where("ts >= '2024-01-18'"), "ts", cutoff)


# --- functions, ML, graph ----------------------------------------------------------------


@query("d01_normalize_city", "SELECT n_nationkey, 'Nation_' || n_nationkey || ' City' AS city, true AS same FROM nation")
def _(t):
    raw = t.nation.select("n_nationkey", F.concat(F.lit("  "), F.lower("n_name"), F.lit(" CITY ")).alias("raw"))
    return raw.select("n_nationkey", udfs.normalize_city(F.col("raw")).alias("city"),
                      (udfs.normalize_city_udf("raw") == udfs.normalize_city(F.col("raw"))).alias("same"))


@query("d02_bucket_age", "SELECT p_partkey, p_size // 10 * 10 AS bucket, p_size // 10 * 10 AS bucket_native FROM part")
def _(t):
    return t.part.select("p_partkey", udfs.bucket_age_udf("p_size").alias("bucket"), udfs.bucket_age(F.col("p_size")).alias("bucket_native"))


@query("d03_named_checks", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT c_acctbal BETWEEN 0 AND 5000")
def _(t):
    return udfs.offending_rows("range", t.customer, "c_acctbal", low=0, high=5000).select("c_custkey", "c_acctbal")


@query("d04_runtime_model", """
SELECT 'not_null' AS "check", 'user_id' AS "column", count(*) FILTER (user_id IS NULL) AS failed_rows FROM events
UNION ALL SELECT 'in_range', 'value', count(*) FILTER (value < 1 OR value > 100) FROM events
UNION ALL SELECT 'is_in', 'event_type', count(*) FILTER (event_type NOT IN ('view', 'click')) FROM events
""")
def _(t):
    config = {"user_id": {"type": "bigint"}, "value": {"type": "double", "required": False, "min": 1, "max": 100},
              "event_type": {"type": "string", "required": False, "choices": ["view", "click"]}}
    schema, rules = udfs.model_from_config(config)
    return quality.run_checks(t.events.select(*schema.fieldNames()), rules).select("check", "column", "failed_rows")


@query("d05_partition_function", "SELECT event_type, count(*) AS rows, min(value) AS least, max(value) AS most FROM events GROUP BY 1")
def _(t):
    """Custom code per partition gives partial rows, which an aggregation combines: the same however the table is split."""
    partial = udfs.map_partitions(t.events.select("event_type", "value"), udfs.batch_extremes("event_type", "value"),
                                  "event_type string, rows long, least double, most double")
    return partial.groupBy("event_type").agg(F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most"))


def _document_features(t):
    def share(chars):
        return 1 - F.length(F.translate("text", chars, "")) / F.length("text")

    return stage(t.documents.join(t.labels, "doc_id").select(
        "doc_id", "quality", F.log1p("n_chars").alias("size"), share(" ").alias("space_share"), share("0123456789").alias("digit_share")), "features")


@query("m01_fit_and_score")
def _(t):
    docs = _document_features(t)
    model = ml.fit_classifier(docs, ["size", "space_share", "digit_share"], "quality")
    return ml.score(model, docs).select("doc_id", "quality", "prediction")


@query("m01_scores_checked", "SELECT doc_id, quality, true AS same FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL AND text <> ''")
def _(t):
    """Each prediction against the fitted weights, written out as an expression."""
    docs, names = _document_features(t).where("size IS NOT NULL AND space_share IS NOT NULL"), ["size", "space_share", "digit_share"]
    model = ml.fit_classifier(docs, names, "quality")
    fitted = model.stages[-1]
    margin = sum((F.col(n) * float(w) for n, w in zip(names, fitted.coefficients)), F.lit(float(fitted.intercept)))
    wanted = (margin > 0).cast("int")
    near = F.abs(margin) < 1e-9  # on the border rounding decides
    return ml.score(model, docs).select("doc_id", "quality", ((F.col("prediction") == wanted) | near).alias("same"))


def _edges(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(F.concat(F.lit("c"), "o_custkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst"))


def _pagerank_sql(rounds):
    parts = ["""pairs AS MATERIALIZED (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)""",
             "shares AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS share FROM pairs)",
             "nodes AS MATERIALIZED (SELECT id, max(o) AS has_out FROM (SELECT src AS id, 1 AS o FROM shares UNION ALL SELECT dst, 0 FROM shares) GROUP BY 1)",
             "r0 AS MATERIALIZED (SELECT id, has_out, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS rank FROM nodes)"]
    for i in range(rounds):
        parts.append(f"""r{i + 1} AS MATERIALIZED (SELECT nodes.id, has_out, 0.15 / (SELECT count(*) FROM nodes) + 0.85 * (coalesce(received, 0) +
          (SELECT coalesce(sum(rank) FILTER (has_out = 0), 0) FROM r{i}) / (SELECT count(*) FROM nodes)) AS rank
          FROM nodes LEFT JOIN (SELECT dst, sum(rank * share) AS received FROM shares JOIN r{i} ON id = src GROUP BY 1) g ON g.dst = nodes.id)""")
    return "WITH " + ",\n".join(parts) + f" SELECT id, round(rank, 9) AS rank FROM r{rounds}"


@query("m02_pagerank", _pagerank_sql(10))
def _(t):
    return graph.pagerank(_edges(t)).withColumn("rank", F.round("rank", 9))


@query("m03_stream_scoring")
def _(t):
    train = t.events.select("event_id", "value", F.hour("ts").cast("double").alias("hour"), (F.col("event_type") == "purchase").cast("int").alias("bought"))
    model = ml.fit_classifier(train, ["value", "hour"], "bought")
    live = event_stream(t).select("event_id", "value", F.hour("event_time").cast("double").alias("hour"))
    path = scratch_path(t.spark, "scored")
    st.start_query(ml.score(model, live), scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    return t.spark.read.parquet(path).select("event_id", "prediction")


@query("m03_stream_equals_batch", "SELECT event_id, true AS same FROM events")
def _(t):
    """Scores of the stream beside those of the whole table by the same model."""
    train = t.events.select("event_id", "value", F.hour("ts").cast("double").alias("hour"), (F.col("event_type") == "purchase").cast("int").alias("bought"))
    model = ml.fit_classifier(train, ["value", "hour"], "bought")
    path = scratch_path(t.spark, "scored")
    live = event_stream(t).select("event_id", "value", F.hour("event_time").cast("double").alias("hour"))
    st.start_query(ml.score(model, live), scratch_path(t.spark, "offsets"), "append", write=st.append_sink(path)).awaitTermination()
    batch = ml.score(model, train).select("event_id", F.col("prediction").alias("wanted"))
    return t.spark.read.parquet(path).join(batch, "event_id").select("event_id", (F.col("prediction") == F.col("wanted")).alias("same"))
