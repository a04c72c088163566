"""Queries for projections, joins, aggregations, windows, sorts and reshaping."""

from datetime import date, datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.sums import partial_sums, whole_sum
from millrace.operators import aggregates as agg
from millrace.operators import columns as cols
from millrace.operators import joins, reshape, windows
from millrace.plans.registry import query
from millrace.session import stage

# --- projections and filters -------------------------------------------------------------


@query("p01_select_cols", "SELECT c_custkey, c_name, c_acctbal, c_acctbal * 2 AS double_bal FROM customer")
def _(t):
    wanted = cols.select_existing(t.customer, ["c_custkey", "c_name", "c_phone", "c_acctbal", "c_mktsegment"])
    return wanted.drop("c_mktsegment").withColumn("double_bal", F.col("c_acctbal") * 2)


@query("p02_rename_columns", "SELECT n_nationkey AS nation_id, n_name AS nation_name FROM nation")
def _(t):
    return cols.rename_columns(t.nation, {"n_nationkey": "nation_id", "n_name": "nation_name"})


@query("p03_filter_rows", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_totalprice >= 250000 AND o_orderpriority IS NOT NULL AND o_orderstatus = 'F'
""")
def _(t):
    keep = (F.col("o_totalprice") >= 250000) & F.col("o_orderpriority").isNotNull() & (F.col("o_orderstatus") == "F")
    return t.orders.where(keep).select("o_orderkey", "o_custkey", "o_totalprice")


@query("p04_bucket_case", """
SELECT p_partkey, CASE WHEN p_size >= 18 THEN 'Adult' ELSE 'Minor' END AS adult_flag,
  CAST(floor(p_size / 10.0) * 10 AS INTEGER) AS decade,
  CASE WHEN p_size < 13 THEN 'child' WHEN p_size < 18 THEN 'teen' WHEN p_size < 60 THEN 'adult' ELSE 'senior' END AS life_stage,
  CASE WHEN p_size > 0 AND p_size <= 18 THEN '0-18' WHEN p_size > 18 AND p_size <= 30 THEN '19-30'
       WHEN p_size > 30 AND p_size <= 50 THEN '31-50' WHEN p_size > 50 AND p_size <= 150 THEN '50+' END AS age_group
FROM part
""")
def _(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey", F.when(size >= 18, "Adult").otherwise("Minor").alias("adult_flag"), cols.decade(size).alias("decade"),
        cols.first_band(size, [(13, "child"), (18, "teen"), (60, "adult")], "senior").alias("life_stage"),
        cols.cut(size, [0, 18, 30, 50, 150], ["0-18", "19-30", "31-50", "50+"]).alias("age_group"))


@query("p05_weather_label", """
WITH c AS (SELECT p_partkey, p_size * 2 AS code FROM part)
SELECT p_partkey, code, CASE WHEN code = 0 THEN 'Cerah' WHEN code BETWEEN 1 AND 3 THEN 'Sebagian Berawan'
  WHEN code BETWEEN 45 AND 48 THEN 'Kabut' WHEN code BETWEEN 51 AND 55 THEN 'Gerimis'
  WHEN code BETWEEN 61 AND 65 OR code BETWEEN 80 AND 82 THEN 'Hujan'
  WHEN code BETWEEN 71 AND 75 OR code BETWEEN 85 AND 86 THEN 'Salju'
  WHEN code BETWEEN 95 AND 99 THEN 'Badai Petir' ELSE 'Kondisi Tidak Diketahui' END AS weather FROM c
""")
def _(t):
    coded = t.part.select("p_partkey", (F.col("p_size") * 2).alias("code"))
    return coded.withColumn("weather", cols.weather_label(F.col("code")))


@query("p06_letter_grade", """
SELECT event_id, value / 5 AS score, CASE WHEN value / 5 >= 90 THEN 'A' WHEN value / 5 >= 80 THEN 'B'
  WHEN value / 5 >= 70 THEN 'C' WHEN value / 5 >= 60 THEN 'D' ELSE 'F' END AS grade FROM events
""")
def _(t):
    scored = t.events.select("event_id", (F.col("value") / 5).alias("score"))
    return scored.withColumn("grade", cols.letter_grade(F.col("score")))


@query("p07_user_status", """
SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '2001-07-02' THEN 'New' ELSE 'Existing' END AS user_status FROM orders
""")
def _(t):
    return t.orders.select("o_orderkey", cols.user_status(F.to_date("o_orderdate"), date(2001, 8, 1)).alias("user_status"))


@query("p08_flatten_struct", """
SELECT event_id AS id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS kind, CAST(value AS DOUBLE) AS amount FROM events
""")
def _(t):
    nested = t.events.select(F.struct("event_id", F.from_json("props", "k int").alias("props"),
                                      F.struct("event_type", "value").alias("body")).alias("rec"))
    return reshape.flatten_fields(nested, {
        "id": ("rec.event_id", "bigint"), "k": ("rec.props.k", "bigint"),
        "kind": ("rec.body.event_type", "string"), "amount": ("rec.body.value", "double")})


@query("p09_sanitize_keys", "SELECT n_name AS some_Key_, n_nationkey AS _1stKey, n_regionkey AS item_Key_ FROM nation")
def _(t):
    odd = t.nation.select(F.struct(F.col("n_name").alias("some Key!"), F.col("n_nationkey").alias("1stKey"),
                                   F.array(F.struct(F.col("n_regionkey").alias("item-Key%"))).alias("list Key")).alias("my rec"))
    clean = reshape.sanitize_names(odd)
    return clean.select("my_rec.some_Key_", "my_rec._1stKey", F.col("my_rec.list_Key")[0]["item_Key_"].alias("item_Key_"))


@query("p10_safe_cast", """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS as_is, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS first_char,
  TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS TIMESTAMP) AS ordered FROM orders
""")
def _(t):
    text = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("as_is"), F.substring("o_orderpriority", 1, 1).alias("first_char"),
                           F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.col("o_orderdate").cast("string")).alias("ordered"))
    return cols.safe_cast(text, {"as_is": "int", "first_char": "int", "ordered": "timestamp_ntz"})


@query("p11_impute", """
WITH d AS (SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS price, CASE WHEN p_size % 3 <> 0 THEN p_brand END AS brand FROM part),
m AS (SELECT EXACT_SUM(price) / count(price) AS mean FROM d)
SELECT p_partkey, coalesce(price, (SELECT mean FROM m)) AS price, coalesce(brand, 'Unknown') AS brand FROM d
""")
def _(t):
    gaps = t.part.select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice")).alias("price"),
                         F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).alias("brand"))
    return cols.impute_constant(cols.impute_mean(gaps, "price"), {"brand": "Unknown"})


@query("p12_null_if_out_of_range", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def _(t):
    return t.customer.select("c_custkey", cols.null_if_outside(F.col("c_acctbal"), low=0).alias("c_acctbal"))


@query("p13_convert_price", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * 15850 AS price_idr, l_extendedprice * (1 - l_discount * 100 / 100) AS discounted,
  l_quantity * l_extendedprice AS total, l_tax * 9 / 5 + 32 AS fahrenheit FROM lineitem
""")
def _(t):
    price = F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (price * 15850).alias("price_idr"),
        cols.discounted(price, F.col("l_discount") * 100).alias("discounted"), (F.col("l_quantity") * price).alias("total"),
        cols.celsius_to_fahrenheit(F.col("l_tax")).alias("fahrenheit"))


@query("p14_add_lineage_cols", """
SELECT s_suppkey, 'batch-1' AS batch_id, '1.0.0' AS pipeline_version, 'supplier' AS source_name, TIMESTAMP '2024-02-01 00:00:00' AS processed_at FROM supplier
""")
def _(t):
    at = F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz")
    return cols.add_lineage(t.supplier.select("s_suppkey"), "batch-1", source="supplier", processed_at=at)


@query("p15_derive_date_parts", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders
""")
def _(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"))
    return cols.derive_date_parts(text, "order_date")


@query("p16_match_event_pattern", """
SELECT event_id, event_type, value FROM events
WHERE event_type IN ('purchase', 'signup') AND (value > 100 AND value <= 400 OR value < 2)
""")
def _(t):
    pattern = {"detail": {"type": ["purchase", "signup"], "size": [{"numeric": [">", 100, "<=", 400]}, {"numeric": ["<", 2]}]}}
    nested = t.events.withColumn("detail", F.struct(F.col("event_type").alias("type"), F.col("value").alias("size")))
    return nested.where(cols.event_pattern(pattern)).select("event_id", "event_type", "value")


@query("p16_match_url_pattern", """
SELECT page_id, url FROM pages WHERE (starts_with(url, 'https://') AND ends_with(url, '1')) OR ends_with(url, '7')
""")
def _(t):
    return t.pages.where(cols.event_pattern({"url": [{"prefix": "https://", "suffix": "1"}, {"suffix": "7"}]})).select("page_id", "url")


@query("p17_flag_large", "SELECT o_orderkey, o_totalprice > 400000 AS is_mega FROM orders")
def _(t):
    return t.orders.select("o_orderkey", (F.col("o_totalprice") > 400000).alias("is_mega"))


@query("p18_sample_rows", """
SELECT * FROM lineitem WHERE substr(md5('42|' || l_orderkey || '|' || l_linenumber), 1, 8) < '1999999a'
""")
def _(t):
    return cols.sample_rows(t.lineitem, 0.1, seed=42, keys=["l_orderkey", "l_linenumber"])


@query("p19_mask_pii", """
SELECT c_custkey, sha256('pepper' || c_name) AS c_name,
  regexp_replace('user' || c_custkey || '@shop.example', '^(.)[^@]*@', '\\1***@') AS email,
  regexp_replace(substr('+62-812-' || c_custkey, 1, length('+62-812-' || c_custkey) - 2), '[0-9]', '*', 'g') || right('+62-812-' || c_custkey, 2) AS phone
FROM customer
""")
def _(t):
    contact = t.customer.select("c_custkey", "c_name", F.format_string("user%d@shop.example", "c_custkey").alias("email"),
                                F.format_string("+62-812-%d", "c_custkey").alias("phone"))
    return cols.mask_pii(contact, {"c_name": "hash", "email": "email", "phone": "phone"}, salt="pepper")


# --- joins -------------------------------------------------------------------------------


@query("j01_inner_join", """
SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
""")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("j02_star_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_name, p_brand, s_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
""")
def _(t):
    joined = joins.star_join(t.lineitem, [(t.part, {"l_partkey": "p_partkey"}), (t.supplier, {"l_suppkey": "s_suppkey"})])
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "p_name", "p_brand", "s_name")


@query("j03_right_join", """
SELECT n_name, s_name, s_acctbal FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey
""")
def _(t):
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select("n_name", "s_name", "s_acctbal")


@query("j03_full_join", """
SELECT o_custkey, orders, user_id, events FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1)
FULL JOIN (SELECT user_id, count(*) AS events FROM events GROUP BY 1) ON o_custkey = user_id
""")
def _(t):
    o = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    e = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return o.join(e, F.col("o_custkey") == F.col("user_id"), "full")


@query("j04_using_left_join", """
WITH p AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS commodity_id, max(o_totalprice) AS price FROM orders GROUP BY ALL),
n AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS commodity_id, count(*) AS news_count FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL)
SELECT date, commodity_id, price, news_count FROM p LEFT JOIN n USING (date, commodity_id)
""")
def _(t):
    o = t.orders.select(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("commodity_id"), "o_totalprice", "o_orderstatus")
    p = o.groupBy("date", "commodity_id").agg(F.max("o_totalprice").alias("price"))
    n = o.where("o_orderstatus = 'O'").groupBy("date", "commodity_id").agg(F.count(F.lit(1)).alias("news_count"))
    return p.join(n, ["date", "commodity_id"], "left")


@query("j05_scalar_cross_join", """
SELECT r_name, n AS nations, biggest AS last_nation FROM region CROSS JOIN (SELECT count(*) AS n, max(n_name) AS biggest FROM nation)
""")
def _(t):
    one = t.nation.agg(F.count(F.lit(1)).alias("nations"), F.max("n_name").alias("last_nation"))
    return cols.attach_scalars(t.region.select("r_name"), one)


@query("j06_broadcast_join", """
SELECT o_orderkey, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def _(t):
    located = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return located.join(joins.checked_broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "n_name")


@query("j07_sort_merge_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def _(t):
    return (t.lineitem.join(t.orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "o_totalprice"))


@query("j08_asof_join", """
WITH s AS (SELECT date_trunc('quarter', l_shipdate) AS d, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderdate, qty AS macro_value, d AS macro_date FROM orders ASOF LEFT JOIN s ON o_orderdate >= d
""")
def _(t):
    series = t.lineitem.groupBy(F.date_trunc("quarter", "l_shipdate").cast("timestamp_ntz").alias("d")).agg(F.sum("l_quantity").alias("qty"))
    return joins.asof_join(t.orders.select("o_orderkey", "o_orderdate"), series, "o_orderdate", "d", [],
                           {"qty": "macro_value", "d": "macro_date"})


@query("j08_asof_join_by_series", """
WITH e AS (SELECT user_id, ts, value FROM events WHERE event_type = 'error'),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT event_id, p.user_id, p.ts, e.value AS last_error, e.ts AS error_ts FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts >= e.ts
""")
def _(t):
    errors = t.events.where("event_type = 'error'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    bought = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return joins.asof_join(bought, errors, "ts", "ts", ["user_id"], {"value": "last_error", "ts": "error_ts"})


@query("j09_anti_join", "SELECT doc_id, lang, source FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    return joins.orphans(t.documents.select("doc_id", "lang", "source"), t.labels, "doc_id", "doc_id")


@query("j10_semi_join", "SELECT c_custkey, c_name FROM customer SEMI JOIN orders ON c_custkey = o_custkey")
def _(t):
    return t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("j11_salted_join", """
SELECT event_id, events.event_type, value, avg_value FROM events JOIN (
  SELECT event_type, EXACT_SUM(value) / count(*) AS avg_value FROM events GROUP BY 1) a USING (event_type)
""")
def _(t):
    kinds = t.events.groupBy("event_type").agg(agg.exact_avg("value").alias("avg_value"))
    return joins.salted_join(t.events.select("event_id", "event_type", "value"), kinds, "event_type", ["event_id"])


@query("j12_split_skew_join", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.split_skew_join(lines, parts, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("j13_lookup_map", """
SELECT p_partkey, p_type, CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'STANDARD' THEN 3 WHEN 'PROMO' THEN 4 END AS type_id,
  coalesce(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'STANDARD' THEN 3 WHEN 'PROMO' THEN 4 END, -1) AS type_id_or_unknown FROM part
""")
def _(t):
    ids = {"ECONOMY": 1, "SMALL": 2, "STANDARD": 3, "PROMO": 4}
    found = joins.map_lookup(F.col("p_type"), ids)
    return t.part.select("p_partkey", "p_type", found.alias("type_id"), F.coalesce(found, F.lit(-1)).alias("type_id_or_unknown"))


@query("j15_order_payment_match", """
WITH o AS (SELECT event_id AS order_id, user_id, ts FROM events WHERE event_type <> 'purchase'),
p AS (SELECT event_id AS payment_id, user_id, ts AS paid_at FROM events WHERE event_type = 'purchase')
SELECT order_id, o.user_id, o.ts, CASE WHEN paid_at <= o.ts + INTERVAL 6 HOUR THEN payment_id END AS payment_id,
  CASE WHEN paid_at <= o.ts + INTERVAL 6 HOUR THEN 'completed' ELSE 'failed' END AS status
FROM o ASOF LEFT JOIN p ON o.user_id = p.user_id AND o.ts <= p.paid_at
""")
def _(t):
    orders = t.events.where("event_type <> 'purchase'").select(F.col("event_id").alias("order_id"), "user_id", "ts")
    paid = t.events.where("event_type = 'purchase'").select(F.col("event_id").alias("payment_id"), "user_id", F.col("ts").alias("paid_at"))
    return joins.await_match(orders, paid, ["user_id"], "ts", "paid_at", "payment_id", 6 * 3600)


@query("j16_coalesce_sources", """
SELECT event_id, coalesce(p.value, s.value) AS value, coalesce(p.event_type, s.event_type) AS event_type,
  CASE WHEN p.event_id IS NOT NULL THEN 'primary' ELSE 'secondary' END AS _source
FROM (SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase')) p
FULL JOIN (SELECT event_id, upper(event_type) AS event_type, value + 1 AS value FROM events) s USING (event_id)
""")
def _(t):
    e = t.events.select("event_id", "event_type", "value")
    backup = e.select("event_id", F.upper("event_type").alias("event_type"), (F.col("value") + 1).alias("value"))
    return joins.coalesce_sources(e.where("event_type IN ('click', 'purchase')"), backup, ["event_id"])


# --- aggregations ------------------------------------------------------------------------


def sales_table(t):
    """Sales records from the order tables: one per line, category and region resolved.

    The region is found per order, before the join with the many lines.
    """
    located = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(located, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"), F.col("p_type").alias("category"),
                F.col("r_name").alias("region"), F.col("l_extendedprice").alias("amount"),
                F.col("l_quantity").cast("int").alias("quantity"), F.to_date("o_orderdate").alias("date"))
        .withColumns({"year": F.year("date"), "month": F.month("date")})
    )


MONTHLY = """
monthly AS (SELECT p_type AS category, r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  EXACT_SUM(l_extendedprice) AS total_revenue, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_quantity,
  count(*) AS transactions_count, EXACT_SUM(l_extendedprice) / count(*) AS avg_transaction_value
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
"""


@query("a01_monthly_sales", f"WITH {MONTHLY} SELECT * FROM monthly")
def _(t):
    return agg.monthly_sales(sales_table(t)).orderBy("year", "month", "category", "region")


@query("a02_group_count_top", """
SELECT c_mktsegment, count(*) AS count, EXACT_SUM(c_acctbal) / count(*) AS avg_bal
FROM customer GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3
""")
def _(t):
    return agg.top_counts(t.customer, "c_mktsegment", 3, [agg.exact_avg("c_acctbal").alias("avg_bal")])


@query("a03_column_profile", """
SELECT 'o_orderkey' AS "column", count(*) - count(o_orderkey) AS nulls, CAST(min(o_orderkey) AS VARCHAR) AS min, CAST(max(o_orderkey) AS VARCHAR) AS max FROM orders
UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice), CAST(min(o_totalprice) AS VARCHAR), CAST(max(o_totalprice) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate), CAST(min(o_orderdate) AS VARCHAR), CAST(max(o_orderdate) AS VARCHAR) FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority), min(o_orderpriority), max(o_orderpriority) FROM orders
""")
def _(t):
    return agg.column_profile(t.orders)


def _described(column):
    mean = f"EXACT_SUM({column}) / count({column})"
    return f"""SELECT '{column}' AS "column", count({column}) AS count, {mean} AS mean, round(stddev_samp({column}), 6) AS stddev,
      CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max FROM lineitem"""


@query("a03_column_describe", " UNION ALL ".join(_described(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def _(t):
    return agg.column_describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("stddev", F.round("stddev", 6))


@query("a04_having", """
SELECT o_custkey, count(*) AS orders, EXACT_SUM(o_totalprice) AS total FROM orders
GROUP BY 1 HAVING count(*) >= 12 AND EXACT_SUM(o_totalprice) >= 1000000
""")
def _(t):
    spent = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), agg.exact_sum("o_totalprice").alias("total"))
    return spent.where("orders >= 12 AND total >= 1000000").orderBy(F.col("total").desc(), "o_custkey")


@query("a05_conditional_pivot", """
SELECT CAST(o_orderdate AS DATE) AS date, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS rate_urgent,
  max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice END) AS rate_high, max(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END) AS rate_medium,
  max(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_totalprice END) AS rate_none,
  max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS rate_low FROM orders GROUP BY 1
""")
def _(t):
    days = t.orders.withColumn("date", F.to_date("o_orderdate"))
    return agg.conditional_pivot(days, ["date"], "o_orderpriority", F.col("o_totalprice"),
                                 {"1-URGENT": "rate_urgent", "2-HIGH": "rate_high", "3-MEDIUM": "rate_medium", "4-NOT SPECIFIED": "rate_none", "5-LOW": "rate_low"})


@query("a06_distinct_count", "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("types"))


@query("a06_approx_distinct_count")
def _(t):
    return t.events.groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("approx_users"))


@query("a07_sales_by_product", """
SELECT p_name, EXACT_SUM(coalesce(CASE WHEN l_linenumber <> 3 THEN l_extendedprice END, 0) * coalesce(CASE WHEN l_linenumber <> 2 THEN l_quantity END, 1)) AS total_sales
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name IS NOT NULL AND p_name <> '' GROUP BY 1
""")
def _(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        "p_name", F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("amount"),
        F.when(F.col("l_linenumber") != 2, F.col("l_quantity")).alias("quantity"))
    return agg.sales_by_product(lines, "p_name", "amount", "quantity")


@query("a08_user_spending", "SELECT user_id, EXACT_SUM(value) AS total_spent FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("user_id").agg(agg.exact_sum("value").alias("total_spent"))


@query("a08_total_value", """
SELECT EXACT_SUM(l_extendedprice * l_quantity) AS total_value FROM lineitem
""")
def _(t):
    return t.lineitem.agg(agg.exact_sum(F.col("l_extendedprice") * F.col("l_quantity")).alias("total_value"))


@query("a09_daily_trade_summary", """
SELECT event_type AS symbol, CAST(ts AS DATE) AS batch_date, EXACT_SUM(value) / count(*) AS avg_price,
  min(value) AS min_price, max(value) AS max_price, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS total_quantity,
  count(*) AS trade_count FROM events GROUP BY 1, 2
""")
def _(t):
    quantity = F.from_json("props", "k int")["k"]
    return agg.trade_summary(t.events, "event_type", "value", quantity, F.to_date("ts"))


CANDLES = """
candles AS (SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, event_type AS symbol,
  arg_min(value, ROW(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, ROW(ts, event_id)) AS close
FROM events GROUP BY ALL)
"""


def minute_candles(t):
    return agg.ohlc(t.events, "ts", "event_type", "value", "event_id")


@query("a10_ohlc", f"WITH {CANDLES} SELECT * FROM candles")
def _(t):
    return minute_candles(t)


def _rollup(minutes):
    @query(f"a11_rollup_candles_{minutes}m", f"""
    WITH {CANDLES} SELECT date_trunc('hour', window_start) + to_minutes(CAST(floor(minute(window_start) / {minutes}) * {minutes} AS BIGINT)) AS time,
      symbol, arg_min(open, window_start) AS open, max(high) AS high, min(low) AS low, arg_max(close, window_start) AS close FROM candles GROUP BY 1, 2
    """)
    def _(t):
        return agg.rollup_candles(minute_candles(t), minutes)


for _m in (5, 15, 45, 60):
    _rollup(_m)


@query("a12_pct_change_first_last", f"""
WITH {CANDLES}, f AS (SELECT symbol, arg_min(close, window_start) AS first_price, arg_max(close, window_start) AS last_price FROM candles GROUP BY 1)
SELECT *, (last_price - first_price) / first_price * 100 AS pct_change FROM f
""")
def _(t):
    return agg.change_first_last(minute_candles(t), "symbol", ["window_start"], "close")


@query("a13_city_averages", """
SELECT n_name AS city, EXACT_SUM(s_acctbal) / count(*) AS avg_temp,
  count(DISTINCT s_suppkey) AS stations, DATE '2024-01-31' AS report_date FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1
""")
def _(t):
    city = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return city.groupBy(F.col("n_name").alias("city")).agg(
        agg.exact_avg("s_acctbal").alias("avg_temp"), F.countDistinct("s_suppkey").alias("stations")).withColumn("report_date", F.lit(date(2024, 1, 31)))


@query("a13_dim_city", "SELECT DISTINCT n_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("city")).distinct()


@query("a14_key_count", "SELECT c_nationkey AS city, count(*) AS n FROM customer GROUP BY 1")
def _(t):
    return t.customer.groupBy(F.col("c_nationkey").alias("city")).agg(F.count(F.lit(1)).alias("n"))


@query("a15_daily_revenue", """
SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS total_orders, EXACT_SUM(o_totalprice) AS total_revenue,
  EXACT_SUM(o_totalprice) / count(*) AS avg_order_value FROM orders GROUP BY 1
""")
def _(t):
    return agg.daily_revenue(t.orders, "o_orderdate", "o_totalprice")


@query("a16_customer_lifetime_value", """
SELECT o_custkey, EXACT_SUM(o_totalprice) AS lifetime_value, count(*) AS orders FROM orders GROUP BY 1
""")
def _(t):
    return agg.lifetime_value(t.orders, "o_custkey", "o_totalprice")


@query("a16_top_products", """
SELECT l_partkey, EXACT_SUM(l_extendedprice) AS revenue FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20
""")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(agg.exact_sum("l_extendedprice").alias("revenue")).orderBy(F.col("revenue").desc(), "l_partkey").limit(20)


@query("a16_customer_cohorts", """
WITH a AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
f AS (SELECT o_custkey, min(month) AS cohort FROM a GROUP BY 1)
SELECT cohort, CAST(date_diff('month', cohort, month) AS INTEGER) AS months_since, count(*) AS customers FROM a JOIN f USING (o_custkey) GROUP BY 1, 2
""")
def _(t):
    return agg.customer_cohorts(t.orders, "o_custkey", "o_orderdate")


@query("a17_errors_by_type", """
SELECT user_id AS error_type, count(*) AS errors, max(ts) AS latest FROM events WHERE event_type = 'error' GROUP BY 1
""")
def _(t):
    return t.events.where("event_type = 'error'").groupBy(F.col("user_id").alias("error_type")).agg(
        F.count(F.lit(1)).alias("errors"), F.max("ts").alias("latest")).orderBy(F.col("errors").desc(), "error_type")


@query("a18_mean_last_7d", """
SELECT event_type, EXACT_SUM(value) / count(*) AS mean_value, TIMESTAMP '2024-01-29 00:00:00' AS as_of FROM events
WHERE ts >= TIMESTAMP '2024-01-22 00:00:00' AND ts < TIMESTAMP '2024-01-29 00:00:00' GROUP BY 1
""")
def _(t):
    return agg.recent_mean(t.events, "event_type", "ts", "value", datetime(2024, 1, 29))


# The five commodity keywords, then frequent words of the documents.
KEYWORDS = ("gold", "silver", "platinum", "copper", "nickel", "the", "and", "license", "der", "que")
_EDGE = r"[^\p{L}\p{N}_]"


@query("a19_mention_counts", " UNION ALL ".join(
    f"SELECT '{k}' AS keyword, count(*) FILTER (regexp_matches(lower(text), '(^|{_EDGE}){k}($|{_EDGE})')) AS documents FROM documents" for k in KEYWORDS))
def _(t):
    return agg.mention_counts(t.documents, "text", KEYWORDS)


@query("a20_iqr_bounds", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(q1, 4) AS q1, round(q3, 4) AS q3, round(q1 - 3.0 * (q3 - q1), 4) AS lower, round(q3 + 3.0 * (q3 - q1), 4) AS upper FROM q
""")
def _(t):
    bounds = agg.iqr_bounds(t.lineitem, ["l_returnflag"], "l_extendedprice")
    return bounds.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("q1", "q3", "lower", "upper")])


@query("a21_dq_metrics", """
SELECT count(*) AS total_records, count(DISTINCT event_type) AS unique_symbols, max(ts) AS latest_timestamp, count(*) FILTER (value <= 0) AS invalid_prices,
  (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1000000 AS data_age_seconds,
  (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 1000000 < 300 AS is_fresh FROM events
""")
def _(t):
    return agg.dq_metrics(t.events, "event_type", "ts", "value", datetime(2024, 1, 31))


@query("a21_symbol_completeness", """
SELECT s AS symbol, count(event_id) AS rows, count(event_id) > 0 AS present FROM (VALUES ('view'), ('click'), ('purchase'), ('refund')) v(s)
LEFT JOIN events ON event_type = s GROUP BY 1
""")
def _(t):
    return agg.symbol_completeness(t.events, "event_type", ["view", "click", "purchase", "refund"])


@query("a22_today_row_count", """
SELECT 'orders' AS table_name, count(*) AS rows, max(o_orderdate) AS latest FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-03-05'
UNION ALL SELECT 'events', count(*), max(ts) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
""")
def _(t):
    return agg.rows_on_date(t.orders, "o_orderdate", date(1998, 3, 5), "orders").unionByName(
        agg.rows_on_date(t.events, "ts", date(2024, 1, 15), "events"))


@query("a23_key_share", "SELECT event_type, count(*) AS rows, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM events) AS share FROM events GROUP BY 1")
def _(t):
    return agg.key_share(t.events, "event_type")


@query("a23_partition_skew", "SELECT CAST(l_linenumber % 8 AS INTEGER) AS partition, count(*) AS rows FROM lineitem GROUP BY 1")
def _(t):
    return agg.partition_sizes(t.lineitem.select("l_linenumber").repartitionById(8, (F.col("l_linenumber") % 8).cast("int")))


# --- windows -----------------------------------------------------------------------------


@query("w01_dedup_row_number", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1
""")
def _(t):
    rest = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return windows.dedup_rows(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col("l_extendedprice").desc(), *rest])


@query("w02_rank_in_group", f"""
WITH {MONTHLY} SELECT *, rank() OVER (PARTITION BY category, year, month ORDER BY total_revenue DESC) AS region_rank FROM monthly
""")
def _(t):
    monthly = stage(agg.monthly_sales(sales_table(t)), "monthly")
    return windows.rank_in_group(monthly, ["category", "year", "month"], "total_revenue", "region_rank")


@query("w02_top2_regions", f"""
WITH {MONTHLY} SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY category, year, month ORDER BY total_revenue DESC) AS INTEGER) AS region_rank FROM monthly) WHERE region_rank <= 2
""")
def _(t):
    return windows.top_per_group(agg.monthly_sales(sales_table(t)), ["category", "year", "month"], [F.col("total_revenue").desc()], 2, "region_rank")


@query("w03_running_total", """
SELECT event_id, user_id, EXACT_SUM(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS running FROM events
""")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    out = windows.running_total(e, ["user_id"], ["ts", "event_id"], F.col("value"), "running")
    return out.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@query("w04_row_number_per_user", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events")
def _(t):
    return windows.row_numbers(t.events.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"]).select(
        "event_id", "user_id", F.col("rn").cast("bigint").alias("rn"))


@query("w05_lag_lead", """
SELECT event_id, user_id, value, lag(value) OVER w AS prev_value, lead(value) OVER w AS next_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def _(t):
    e = t.events.select("event_id", "user_id", "ts", "value")
    return windows.lag_lead(e, ["user_id"], ["ts", "event_id"], "value", "prev_value", "next_value").drop("ts")


@query("w06_price_anomalies", """
WITH l AS (SELECT event_id, event_type, ts, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous_price FROM events),
c AS (SELECT *, (value - previous_price) / nullif(previous_price, 0) AS change_pct FROM l)
SELECT *, CASE WHEN abs(change_pct) >= 0.20 THEN 'HIGH' ELSE 'MEDIUM' END AS severity, 'Price changed ' || printf('%.2f', change_pct * 100) || '%' AS message
FROM c WHERE abs(change_pct) >= 0.10
""")
def _(t):
    ticks = t.events.select("event_id", "event_type", "ts", "value")
    return windows.price_alerts(ticks, "event_type", ["ts", "event_id"], "value")


@query("w07_drop_repeat_ticks", """
SELECT event_id, event_type, ts FROM (SELECT *, date_trunc('hour', ts) AS f, lag(date_trunc('hour', ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS p FROM events)
WHERE f IS DISTINCT FROM p
""")
def _(t):
    ticks = t.events.select("event_id", "event_type", "ts")
    return windows.drop_repeats(ticks, ["event_type"], ["ts", "event_id"], F.date_trunc("hour", "ts"))


@query("w08_moving_average", """
SELECT event_id, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS avg_1h FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
""")
def _(t):
    e = t.events.select("event_id", "event_type", "ts", "value")
    return windows.moving_average(e, ["event_type"], "ts", F.col("value").cast("decimal(18,2)"), 3600, "avg_1h").select("event_id", "avg_1h")


@query("w09_latest_per_key", "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def _(t):
    return windows.latest_per_key(t.events, ["event_type"], ["ts", "event_id"])


@query("w10_locf_fill", """
SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events
""")
def _(t):
    sparse = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return windows.locf(sparse, ["user_id"], ["ts", "event_id"], "value", "filled").select("event_id", "user_id", "filled")


# --- sorts, limits, sets -----------------------------------------------------------------


@query("o01_multi_key_sort", f"WITH {MONTHLY} SELECT year, month, category, region, total_revenue FROM monthly ORDER BY year, month, total_revenue DESC")
def _(t):
    return (agg.monthly_sales(sales_table(t)).select("year", "month", "category", "region", "total_revenue")
            .orderBy(F.col("year").asc(), F.col("month").asc(), F.col("total_revenue").desc(), "category", "region"))


@query("o02_top_k", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def _(t):
    return t.customer.select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(10)


@query("o02_top_nations", """
SELECT n_name, EXACT_SUM(o_totalprice) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def _(t):
    # Totals per customer first: the join then carries one row per customer, not per order.
    spent = t.orders.groupBy("o_custkey").agg(*partial_sums("o_totalprice", "spent"))
    placed = spent.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.groupBy("n_name").agg(whole_sum("spent").alias("total")).orderBy(F.col("total").desc(), "n_name").limit(10)


@query("o03_time_range_series", """
SELECT ts - INTERVAL 7 HOUR AS time, value FROM events WHERE event_type = 'purchase' AND ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'
""")
def _(t):
    inside = F.col("ts").between(F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit("2024-01-12 00:00:00").cast("timestamp_ntz"))
    return t.events.where((F.col("event_type") == "purchase") & inside).select((F.col("ts") - F.expr("INTERVAL 7 HOURS")).alias("time"), "value").orderBy("time")


@query("o04_distinct_symbols", "SELECT DISTINCT event_type AS symbol FROM events")
def _(t):
    return t.events.select(F.col("event_type").alias("symbol")).distinct().orderBy("symbol")


@query("x01_union_all", "SELECT s_name AS name, s_acctbal AS bal, 'supplier' AS kind FROM supplier UNION ALL SELECT c_name, c_acctbal, 'customer' FROM customer")
def _(t):
    s = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"), F.lit("supplier").alias("kind"))
    return s.unionByName(t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"), F.lit("customer").alias("kind")))


@query("x02_union_evolved", "SELECT n_name AS name, n_regionkey AS regionkey, NULL AS volume FROM nation UNION ALL SELECT r_name, r_regionkey, 0.5 FROM region")
def _(t):
    v1 = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("regionkey"))
    return reshape.union_evolved(v1, t.region.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("regionkey"), F.lit(0.5).alias("volume")))


@query("x03_distinct", "SELECT DISTINCT text FROM documents")
def _(t):
    return t.documents.select("text").distinct()


@query("x03_drop_duplicates", "SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def _(t):
    # the digest is the shuffle key, so that no text moves
    rows = t.documents.select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))
    return windows.dedup_rows(rows, ["digest"], ["doc_id"]).drop("digest")


# Names of the wide columns for the five order priorities.
_METALS = {"1-URGENT": "gold", "2-HIGH": "silver", "3-MEDIUM": "platinum", "4-NOT SPECIFIED": "nickel", "5-LOW": "copper"}


@query("x04_unpivot", "WITH p AS (SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(
    f"max(CASE WHEN o_orderpriority = '{k}' THEN o_totalprice END) AS {v}" for k, v in _METALS.items()) + """ FROM orders GROUP BY 1)
SELECT date, commodity_id, price FROM (UNPIVOT p ON gold, silver, platinum, nickel, copper INTO NAME commodity_id VALUE price)
""")
def _(t):
    days = t.orders.withColumn("date", F.to_date("o_orderdate"))
    wide = agg.conditional_pivot(days, ["date"], "o_orderpriority", F.col("o_totalprice"), {k: f"{v}_price" for k, v in _METALS.items()})
    return reshape.unpivot_values(wide, ["date"], {f"{v}_price": v for v in _METALS.values()}, "commodity_id", "price")


@query("x05_explode_map", "SELECT event_id, 'k' AS code, CAST(json_extract(props, '$.k') AS DOUBLE) AS rate FROM events")
def _(t):
    maps = t.events.select("event_id", F.from_json("props", "map<string,double>").alias("rates"))
    return reshape.explode_entries(maps, "rates", "code", "rate")


@query("x06_explode_json_array", """
SELECT event_id, event_type AS series_id, strftime(ts, '%Y-%m-%d') AS date, value FROM events WHERE event_id % 10 <> 0
UNION ALL SELECT event_id, event_type, '1999-01-01', value * 2 FROM events
""")
def _(t):
    obs = F.array(
        F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(F.col("event_id") % 10 == 0, ".").otherwise(F.col("value").cast("string")).alias("value")),
        F.struct(F.lit("1999-01-01").alias("date"), (F.col("value") * 2).cast("string").alias("value")))
    docs = t.events.select("event_id", F.to_json(F.create_map("event_type", F.struct(obs.alias("observations")))).alias("macro"))
    return reshape.explode_observations(docs, "macro", keep=["event_id"])
