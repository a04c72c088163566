"""Queries for cleaning and validation. Messy inputs are derived from the tables."""

from datetime import datetime

from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.plans.registry import query


def joined(errors):
    return F.array_join(errors, "; ")


@query("c01_clean_emails", """
WITH m AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '  ' || c_name || '@Shop.COM ' WHEN 1 THEN c_name WHEN 2 THEN '' END AS raw FROM customer)
SELECT c_custkey, coalesce(lower(trim(raw)), '') AS email, CASE WHEN coalesce(raw, '') <> '' AND NOT contains(raw, '@') THEN 'Invalid email format: ' || raw ELSE '' END AS errors FROM m
""")
def _(t):
    k = F.col("c_custkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("  "), "c_name", F.lit("@Shop.COM "))).when(k == 1, F.col("c_name")).when(k == 2, "")
    m = t.customer.select("c_custkey", raw.alias("raw"))
    return m.select("c_custkey", clean.clean_email(F.col("raw")).alias("email"), joined(clean.email_errors(F.col("raw"))).alias("errors"))


@query("c02_parse_amounts", """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 2 THEN floor(o_totalprice) WHEN 4 THEN 0.0 WHEN 5 THEN NULL ELSE o_totalprice END AS amount FROM orders
""")
def _(t):
    us = F.format_number("o_totalprice", 2)
    k = F.col("o_orderkey") % 6
    raw = (F.when(k == 0, F.concat(F.lit("$"), us)).when(k == 1, F.translate(us, ",.", ".,"))
           .when(k == 2, F.concat(F.lit("Rp "), F.translate(F.format_number(F.floor("o_totalprice"), 0), ",", ".")))
           .when(k == 3, F.col("o_totalprice").cast("string")).when(k == 4, "").otherwise("n/a"))
    return clean.parse_amounts(t.orders.select("o_orderkey", raw.alias("raw")), "raw", "amount").drop("raw")


@query("c03_parse_amounts_lenient", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_totalprice WHEN 1 THEN floor(o_totalprice) ELSE 0.0 END AS amount FROM orders")
def _(t):
    k = F.col("o_orderkey") % 3
    raw = (F.when(k == 0, F.concat(F.lit("  $ "), F.format_number("o_totalprice", 2)))
           .when(k == 1, F.concat(F.lit("Rp "), F.floor("o_totalprice").cast("string"))).otherwise("invalid"))
    return t.orders.select("o_orderkey", clean.parse_amount_lenient(raw).alias("amount"))


@query("c04_normalize_timestamps", """
SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN strftime(ts, '%Y-%m-%d') END AS day, CASE WHEN event_id % 3 <> 2 THEN strftime(ts, '%d/%m/%Y') END AS day_first FROM events
""")
def _(t):
    utc = F.col("ts").cast("timestamp")
    k = F.col("event_id") % 3
    raw = (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
           .when(k == 1, F.unix_millis(utc).cast("string")).otherwise("not a time"))
    return t.events.select("event_id", clean.format_instant(raw).alias("day"), clean.format_instant(raw, "dd/MM/yyyy").alias("day_first"))


@query("c05_normalize_symbols", """
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN 'UNKNOWN' ELSE regexp_replace(upper(p_brand), '[^A-Z]', '-', 'g') END AS symbol FROM part
""")
def _(t):
    raw = F.when(F.col("p_size") % 7 != 0, F.concat(F.lit(" "), "p_brand", F.lit(" ")))
    return t.part.select("p_partkey", clean.normalize_symbol(raw).alias("symbol"))


@query("c06_clean_phones", """
SELECT c_custkey, '+62812' || c_custkey AS phone, 5 + length(CAST(c_custkey AS VARCHAR)) >= 10 AS phone_ok FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, '', NULL FROM customer WHERE c_custkey % 5 = 0
""")
def _(t):
    raw = F.when(F.col("c_custkey") % 5 != 0, F.format_string("+62 (812)-%d", "c_custkey"))
    return t.customer.select("c_custkey", clean.clean_phone(raw).alias("phone"), clean.phone_ok(raw).alias("phone_ok"))


@query("c07_validate_emails", r"""
WITH m AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'user' || c_custkey || '@shop.example' WHEN 1 THEN 'user' || c_custkey || '@shop'
  WHEN 2 THEN 'a@b@c.d' WHEN 3 THEN 'user name' || c_custkey || '@shop.example' END AS email FROM customer)
SELECT c_custkey, coalesce(regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$'), false) AS strict_ok,
  coalesce(len(string_split(email, '@')) = 2 AND string_split(email, '@')[1] <> '' AND contains(string_split(email, '@')[2], '.'), false) AS structure_ok FROM m
""")
def _(t):
    k = F.col("c_custkey") % 5
    raw = (F.when(k == 0, F.format_string("user%d@shop.example", "c_custkey")).when(k == 1, F.format_string("user%d@shop", "c_custkey"))
           .when(k == 2, "a@b@c.d").when(k == 3, F.format_string("user name%d@shop.example", "c_custkey")))
    m = t.customer.select("c_custkey", raw.alias("email"))
    return m.select("c_custkey", clean.email_ok(F.col("email")).alias("strict_ok"), clean.email_structure_ok(F.col("email")).alias("structure_ok"))


@query("c08_validate_users", """
WITH u AS (SELECT c_custkey AS user_id, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS name,
  CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'user' || c_custkey ELSE 'user' || c_custkey || '@shop.example' END AS email,
  c_nationkey * 7 - 10 AS age, CASE WHEN c_custkey % 3 = 0 THEN '0812-' || c_custkey END AS phone FROM customer)
SELECT user_id, CASE WHEN email IS NULL THEN 'Missing required field: email' ELSE concat_ws('; ',
  CASE WHEN user_id <= 0 THEN 'user_id must be a positive integer' END, CASE WHEN name = '' THEN 'name must be a non-empty string' END,
  CASE WHEN NOT contains(email, '@') THEN 'Invalid email format: ' || email END, CASE WHEN age < 0 THEN 'Age cannot be negative' END,
  CASE WHEN age > 150 THEN 'Age cannot exceed 150' END,
  CASE WHEN length(phone) - 1 < 10 THEN 'Phone number must have at least 10 digits, got ' || (length(phone) - 1) END) END AS errors FROM u
""")
def _(t):
    k = F.col("c_custkey")
    email = F.when(k % 13 == 0, None).when(k % 7 == 0, F.format_string("user%d", k)).otherwise(F.format_string("user%d@shop.example", k))
    users = t.customer.select(k.alias("user_id"), F.when(k % 11 == 0, "").otherwise(F.col("c_name")).alias("name"), email.alias("email"),
                              (F.col("c_nationkey") * 7 - 10).alias("age"), F.when(k % 3 == 0, F.format_string("0812-%d", k)).alias("phone"))
    return users.select("user_id", joined(clean.user_errors()).alias("errors"))


@query("c08_validate_signups", """
WITH u AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'plain' ELSE 'a@b.c' END AS email,
  CASE c_custkey % 3 WHEN 0 THEN 'user_' || c_custkey WHEN 1 THEN 'user ' || c_custkey END AS username, CASE WHEN c_nationkey > 2 THEN c_nationkey END AS age FROM customer)
SELECT c_custkey, concat_ws('; ', CASE WHEN email = '' THEN 'Email is required' WHEN email = 'plain' THEN 'Email format invalid' END,
  CASE WHEN username IS NULL THEN 'Username is required' WHEN contains(username, ' ') THEN 'Username must be alphanumeric' END,
  CASE WHEN age IS NULL THEN 'Age is required' WHEN age < 18 THEN 'User must be at least 18 years old' END) AS errors FROM u
""")
def _(t):
    k = F.col("c_custkey")
    u = t.customer.select(k, F.when(k % 4 == 0, "").when(k % 4 == 1, "plain").otherwise("a@b.c").alias("email"),
                          F.when(k % 3 == 0, F.format_string("user_%d", k)).when(k % 3 == 1, F.format_string("user %d", k)).alias("username"),
                          F.when(F.col("c_nationkey") > 2, F.col("c_nationkey")).alias("age"))
    return u.select("c_custkey", joined(clean.signup_errors()).alias("errors"))


@query("c09_validate_transactions", """
WITH x AS (SELECT event_id, value - 1 AS amount, CASE user_id % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'IDR' WHEN 3 THEN 'SGD' WHEN 4 THEN 'GBP' END AS currency,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE ts END AS made FROM events)
SELECT event_id, CASE WHEN currency IS NULL THEN 'Missing required field: currency' ELSE concat_ws('; ',
  CASE WHEN amount <= 0 THEN 'amount must be positive' END, CASE WHEN currency = 'GBP' THEN 'currency must be one of USD, EUR, IDR, SGD' END,
  CASE WHEN made IS NULL THEN 'timestamp must be valid ISO format' END, CASE WHEN made > TIMESTAMP '2024-01-20 12:00:00' THEN 'timestamp cannot be in the future' END,
  CASE WHEN TIMESTAMP '2024-01-20 12:00:00' - made > INTERVAL 24 HOUR THEN 'timestamp must be within last 24 hours' END) END AS errors FROM x
""")
def _(t):
    u = F.col("user_id") % 6
    x = t.events.select(
        "event_id", F.col("event_id").cast("string").alias("transaction_id"), (F.col("value") - 1).alias("amount"),
        F.when(u == 0, "USD").when(u == 1, "EUR").when(u == 2, "IDR").when(u == 3, "SGD").when(u == 4, "GBP").alias("currency"),
        F.when(F.col("event_id") % 9 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).alias("timestamp"))
    return x.select("event_id", joined(clean.transaction_errors(datetime(2024, 1, 20, 12))).alias("errors"))


@query("c10_validate_cards", """
WITH c AS (SELECT event_id, lpad(CAST(event_id * 7919 + 4000000000000 AS VARCHAR), CASE WHEN event_id % 10 = 0 THEN 12 ELSE 16 END, '4') AS digits,
  CAST(user_id * 7 AS VARCHAR) AS cvv, CAST(user_id % 14 AS INTEGER) AS m, CAST(2022 + user_id % 5 AS INTEGER) AS y FROM events),
l AS (SELECT *, list_sum(list_transform(range(1, length(digits) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(digits[length(digits) + 1 - i] AS INTEGER)
  ELSE (CAST(digits[length(digits) + 1 - i] AS INTEGER) * 2) // 10 + (CAST(digits[length(digits) + 1 - i] AS INTEGER) * 2) % 10 END)) % 10 = 0 AS luhn FROM c)
SELECT event_id, digits AS card, concat_ws('; ', CASE WHEN length(digits) NOT BETWEEN 13 AND 19 THEN 'Card number must be 13-19 digits' WHEN NOT luhn THEN 'Invalid card number (failed Luhn check)' END,
  CASE WHEN length(cvv) NOT BETWEEN 3 AND 4 THEN 'CVV must be 3 or 4 digits' END, CASE WHEN m NOT BETWEEN 1 AND 12 THEN 'expiry_month must be 1-12' END,
  CASE WHEN y < 2024 OR (y = 2024 AND m < 6) THEN 'Card has expired' END) AS errors FROM l
""")
def _(t):
    digits = F.expr("lpad(CAST(event_id * 7919 + 4000000000000 AS STRING), IF(event_id % 10 = 0, 12, 16), '4')")
    cards = t.events.select("event_id", F.regexp_replace(digits, "(....)", "$1-").alias("card_number"), (F.col("user_id") * 7).cast("string").alias("cvv"),
                            (F.col("user_id") % 14).cast("int").alias("expiry_month"), (2022 + F.col("user_id") % 5).cast("int").alias("expiry_year"))
    return cards.select("event_id", clean.card_digits(F.col("card_number")).alias("card"), joined(clean.card_errors(datetime(2024, 6, 15))).alias("errors"))


@query("c11_validate_passwords_and_names", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name,
  concat_ws('; ', CASE WHEN length(p_brand) < 8 THEN 'password shorter than 8 characters' END,
  CASE WHEN p_size % 4 = 0 THEN 'password needs an uppercase letter' END, CASE WHEN p_size % 3 = 0 THEN 'passwords do not match' END) AS errors FROM part
""")
def _(t):
    password = F.when(F.col("p_size") % 4 == 0, F.lower("p_brand")).otherwise(F.col("p_brand"))
    again = F.when(F.col("p_size") % 3 == 0, F.lit("other")).otherwise(password)
    messy = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" \t ")), F.lit(" "))
    return t.part.select("p_partkey", clean.clean_name(messy).alias("name"), joined(clean.password_errors(password, again)).alias("errors"))


@query("c12_validate_ticks", """
SELECT event_id, CASE WHEN event_id % 8 = 0 THEN 'XY' ELSE upper(event_type) END AS symbol, concat_ws('; ',
  CASE WHEN event_id % 8 = 0 THEN 'symbol must have 3-10 characters' END, CASE WHEN value - 5 <= 0 THEN 'price must be positive' END,
  CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) - 10 < 0 THEN 'volume must not be negative' END,
  CASE WHEN ts > TIMESTAMP '2024-01-25 00:00:00' THEN 'timestamp is in the future' END) AS errors FROM events
""")
def _(t):
    ticks = t.events.select("event_id", F.upper(F.when(F.col("event_id") % 8 == 0, "xy").otherwise(F.col("event_type"))).alias("symbol"),
                            (F.col("value") - 5).alias("price"), (F.from_json("props", "k int")["k"] - 10).alias("volume"), F.col("ts").alias("timestamp"))
    return ticks.select("event_id", "symbol", joined(clean.tick_errors(datetime(2024, 1, 25))).alias("errors"))


@query("c13_parse_trades", """
SELECT event_id, event_type AS symbol, value AS price, epoch_us(ts) // 1000000 AS event_time, date_trunc('second', ts) AS event_ts FROM events
""")
def _(t):
    raw = F.to_json(F.struct(F.col("event_type").alias("s"), F.col("value").cast("string").alias("p"), F.unix_millis(F.col("ts").cast("timestamp")).alias("T")))
    out = clean.parse_trades(t.events.select("event_id", raw.alias("raw")), "raw")
    return out.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query("c14_to_local_time", """
SELECT CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day, count(*) AS events FROM events GROUP BY 1
""")
def _(t):
    local = clean.to_local_time(F.col("ts").cast("timestamp"))
    return t.events.groupBy(F.to_date(local).alias("local_day")).agg(F.count(F.lit(1)).alias("events"))


@query("c15_extract_weather", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS time, value / 10 AS temperature_2m, CAST(floor(value / 100) AS INTEGER) AS precipitation, value AS wind_speed_10m,
  CAST(json_extract(props, '$.k') AS DOUBLE) AS relative_humidity_2m, value / 10 - 2 AS apparent_temperature,
  CASE WHEN event_id % 100 = 0 THEN 'Cerah' WHEN event_id % 100 BETWEEN 1 AND 3 THEN 'Sebagian Berawan' WHEN event_id % 100 BETWEEN 45 AND 48 THEN 'Kabut'
  WHEN event_id % 100 BETWEEN 51 AND 55 THEN 'Gerimis' WHEN event_id % 100 BETWEEN 61 AND 65 OR event_id % 100 BETWEEN 80 AND 82 THEN 'Hujan'
  WHEN event_id % 100 BETWEEN 71 AND 75 OR event_id % 100 BETWEEN 85 AND 86 THEN 'Salju' WHEN event_id % 100 BETWEEN 95 AND 99 THEN 'Badai Petir'
  ELSE 'Kondisi Tidak Diketahui' END AS weather FROM events
""")
def _(t):
    now = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), (F.col("value") / 10).alias("temperature_2m"), (F.col("value") / 100).alias("precipitation"),
        F.col("value").alias("wind_speed_10m"), F.from_json("props", "k double")["k"].alias("relative_humidity_2m"),
        (F.col("value") / 10 - 2).alias("apparent_temperature"), (F.col("event_id") % 100).cast("int").alias("weather_code"))
    docs = t.events.select("event_id", F.to_json(F.struct(now.alias("current"))).alias("raw"))
    return clean.extract_weather(docs, "raw", truncate=True)


@query("c16_validate_payloads", """
SELECT s_suppkey, concat_ws('; ', CASE WHEN s_suppkey % 6 = 0 THEN 'currency_base: field required' END,
  CASE WHEN s_suppkey % 9 = 0 THEN 'metals dictionary must not be empty' END,
  CASE WHEN s_suppkey % 9 <> 0 AND s_acctbal - 500 <= 0 THEN 'metals: value must be greater than 0' END) AS metal_errors,
  CASE WHEN s_suppkey % 9 <> 0 THEN 2 ELSE 0 END AS kept_metals,
  CASE WHEN s_suppkey % 4 = 0 THEN 'rates: IDR is missing' ELSE '' END AS rate_errors,
  CASE WHEN s_suppkey % 5 = 0 THEN 'observations list must not be empty' WHEN s_suppkey % 5 = 1 THEN 'each observation must contain date and value keys' ELSE '' END AS macro_errors,
  CASE WHEN s_nationkey > 12 THEN 'status must be "ok"' ELSE '' END AS news_errors FROM supplier
""")
def _(t):
    k, price = F.col("s_suppkey"), F.col("s_acctbal") - 500
    metals = F.when(k % 9 == 0, F.create_map().cast("map<string,double>")).otherwise(
        F.create_map(F.lit("gold"), price, F.lit("nickel"), F.abs(price) + 1, F.lit("lead"), F.lit(2.0)))
    metal = F.struct(F.lit("2026-01-29T08:21:02Z").alias("timestamp"), F.lit("success").alias("status"), metals.alias("metals"),
                     F.when(k % 6 != 0, "USD").alias("currency_base"))
    rates = F.struct(F.lit("2026-01-29").alias("date"), F.lit("USD").alias("base"),
                     F.when(k % 4 == 0, F.create_map(F.lit("EUR"), F.lit(0.9))).otherwise(F.create_map(F.lit("EUR"), F.lit(0.9), F.lit("IDR"), F.lit(15850.0))).alias("rates"))
    one = F.struct(F.lit("2026-01-01").alias("date"), F.when(k % 5 != 1, F.col("s_acctbal").cast("string")).alias("value"))
    macro = F.struct(F.lit(1).alias("count"), F.lit(0).alias("offset"), F.lit(10).alias("limit"),
                     F.when(k % 5 == 0, F.array().cast("array<struct<date:string,value:string>>")).otherwise(F.array(one)).alias("observations"))
    news = F.struct(F.when(F.col("s_nationkey") <= 12, "ok").otherwise("error").alias("status"), k.alias("totalResults"))
    p = t.supplier.select("s_suppkey", metal.alias("metal"), rates.alias("rates"), macro.alias("macro"), news.alias("news"))
    return p.select("s_suppkey", joined(clean.metal_payload_errors(F.col("metal"))).alias("metal_errors"),
                    F.cardinality(clean.relevant_metals(F.col("metal.metals"))).alias("kept_metals"),
                    joined(clean.rates_errors(F.col("rates"))).alias("rate_errors"), joined(clean.macro_errors(F.col("macro"))).alias("macro_errors"),
                    joined(clean.news_errors(F.col("news"))).alias("news_errors"))


@query("c17_validate_api_envelope", """
SELECT event_id, CASE event_type WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'a success response must have data' ELSE '' END
  WHEN 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'an error response must have a message' ELSE '' END ELSE 'status must be success or error' END AS errors,
  user_id * 10 < 700 AS has_more FROM events
""")
def _(t):
    e = t.events.select("event_id", "user_id", F.when(F.col("event_type") == "view", "success").otherwise(F.col("event_type")).alias("status"),
                        F.when(F.col("event_id") % 2 != 0, F.col("props")).alias("data"), F.when(F.col("event_id") % 3 != 0, "boom").alias("error"))
    return e.select("event_id", joined(clean.envelope_errors()).alias("errors"), clean.has_more(F.col("user_id"), F.lit(10), F.lit(700)).alias("has_more"))


@query("c18_normalize_webhooks", """
SELECT event_id, CASE event_type WHEN 'signup' THEN 'user_created' WHEN 'click' THEN 'user_updated' WHEN 'error' THEN 'user_deleted' ELSE event_type END AS event_type,
  CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 11 <> 0 THEN date_trunc('millisecond', ts) END AS event_ts,
  concat_ws('; ', CASE WHEN event_type NOT IN ('signup', 'click', 'error') THEN 'unknown event_type' END,
  CASE WHEN event_id % 10 = 0 OR user_id <= 0 THEN 'user_id must be a positive integer' END, CASE WHEN event_id % 11 = 0 THEN 'invalid timestamp' END) AS errors FROM events
""")
def _(t):
    kind = F.col("event_type")
    kind = F.when(kind == "signup", "user_created").when(kind == "click", "user_updated").when(kind == "error", "user_deleted").otherwise(kind)
    data = F.when(F.col("event_id") % 10 == 0, F.create_map(F.lit("name"), F.lit("x"))).otherwise(F.create_map(F.lit("user_id"), F.col("user_id").cast("string")))
    at = F.when(F.col("event_id") % 11 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    out = clean.normalize_webhooks(t.events.select("event_id", kind.alias("event_type"), data.alias("data"), at.alias("timestamp")))
    return out.select("event_id", "event_type", "user_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), joined(F.col("errors")).alias("errors"))


@query("c19_standardise_orders", """
SELECT 'ORD-' || o_orderkey AS order_id, 'CUST-' || o_custkey AS customer_id, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'OPEN' ELSE 'PENDING' END AS status, o_totalprice AS total, TIMESTAMP '2024-01-15 12:00:00' AS inserted_at FROM orders
""")
def _(t):
    s = F.col("o_orderstatus")
    messy = t.orders.select(
        F.concat(F.lit("ORD-"), "o_orderkey").alias("order_id"), F.concat(F.lit(" CUST-"), "o_custkey", F.lit(" ")).alias("customer_id"),
        F.when(F.col("o_orderkey") % 10 == 0, "15.01.24").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("order_date"),
        F.when(s == "F", "Completed").when(s == "O", "open").otherwise("Pending").alias("status"),
        F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit(" ")).alias("total"))
    return clean.standardise_orders(messy, datetime(2024, 1, 15, 12))


@query("c20_build_struct_array_json", """
SELECT n_nationkey, '{"id":' || n_nationkey || ',"name":"' || n_name || '","codes":[' || n_nationkey || ',' || n_regionkey || ']}' AS doc, n_regionkey AS second_code FROM nation
""")
def _(t):
    rec = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.array("n_nationkey", "n_regionkey").alias("codes"))
    docs = t.nation.select("n_nationkey", F.to_json(rec).alias("doc"))
    back = docs.withColumn("parsed", F.from_json("doc", "id int, name string, codes array<int>"))
    return back.select("n_nationkey", "doc", F.col("parsed.codes")[1].alias("second_code"))


@query("c21_parse_json_strict", """
SELECT event_id, CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
  CASE event_id % 5 WHEN 0 THEN 'empty JSON' WHEN 1 THEN 'invalid JSON' END AS error FROM events
""")
def _(t):
    k = F.col("event_id") % 5
    raw = F.when(k == 0, "").when(k == 1, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    out = clean.parse_json_strict(t.events.select("event_id", raw.alias("raw")), "raw", "k int")
    return out.select("event_id", F.col("parsed.k").alias("k"), "error")


@query("c22_clean_text", r"SELECT doc_id, md5(regexp_replace(lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g')) AS text_md5 FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(clean.clean_text(F.col("text"))).alias("text_md5"))


@query("c23_processing_delay", """
SELECT event_id, epoch_us(ts + to_milliseconds(event_id % 600 * 500)) // 1000000 - epoch_us(ts) // 1000000 AS processing_delay_seconds FROM events
""")
def _(t):
    at = F.col("ts").cast("timestamp")
    broker = F.timestamp_micros(F.unix_micros(at) + F.col("event_id") % 600 * 500_000)
    return t.events.select("event_id", clean.delay_seconds(broker, at).alias("processing_delay_seconds"))
