"""Golden values of the cleaning rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.operators import columns, reshape
from tests.conftest import rows


def apply(spark, values, fn, ddl="x string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r[0] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_amounts(spark):
    texts = ["$1,234.56", "Rp 1.234.567", "1234.56", "", "1.234,56", "1.234", "1,234,567", "1234,56", "12,5", None, "abc", "1d", " $ 7 "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = [r["a"] for r in clean.parse_amounts(df, "x", "a").orderBy("i").collect()]
    assert got == [1234.56, 1234567.0, 1234.56, 0.0, 1234.56, 1234.0, 1234567.0, 1234.56, 125.0, 0.0, None, None, 7.0]


def test_lenient_amounts(spark):
    got = apply(spark, ["$1234.56", "Rp 1234567", "$1,234.56", "", "invalid", "$0", "  $  999.99  "], clean.parse_amount_lenient)
    assert got == [1234.56, 1234567.0, 1234.56, 0.0, 0.0, 0.0, 999.99]


def test_symbols(spark):
    assert apply(spark, ["btc-usd", " ETH_USD ", "LTC/USD", "xrpusd", "", None], clean.normalize_symbol) == [
        "BTC-USD", "ETH-USD", "LTC-USD", "XRPUSD", "UNKNOWN", "UNKNOWN"]


def test_fahrenheit(spark):
    got = apply(spark, [0.0, 100.0, -40.0, 37.0, -273.15], columns.celsius_to_fahrenheit, "x double")
    assert got == pytest.approx([32, 212, -40, 98.6, -459.67])


def test_instants(spark):
    texts = ["2024-01-15T10:30:00Z", "1705318200000", "soon", None]
    assert apply(spark, texts, clean.format_instant) == ["2024-01-15", "2024-01-15", None, None]
    assert apply(spark, texts[:1], lambda c: clean.format_instant(c, "dd/MM/yyyy")) == ["15/01/2024"]


def test_emails(spark):
    assert apply(spark, ["  JohN@Example.COM  ", "", None], clean.clean_email) == ["john@example.com", "", ""]
    assert apply(spark, ["nope", "a@b", ""], lambda c: F.size(clean.email_errors(c))) == [1, 0, 0]
    texts = ["a.b+c@d-e.com", "a@b", "@b.c", "a@@b.c", "a@.c", "a b@c.d", "", None]
    assert apply(spark, texts, clean.email_ok) == [True, False, False, False, False, False, False, False]
    assert apply(spark, texts, clean.email_structure_ok) == [True, False, False, False, True, True, False, False]


def test_phones(spark):
    assert apply(spark, ["+62 812-3456 (7890)", "abc", None], clean.clean_phone) == ["+6281234567890", "", ""]
    assert apply(spark, ["+62 812-3456 (7890)", "12345"], clean.phone_ok) == [True, False]


def test_users_missing_fields_stop_the_rest(spark):
    df = spark.createDataFrame([(None, "", None, -1, None), (0, "", "bad", 200, "123"), (1, "Ann", "a@b.co", 30, None)],
                               "user_id int, name string, email string, age int, phone string")
    got = [r[0] for r in df.select(clean.user_errors()).collect()]
    assert got[0] == ["Missing required field: user_id", "Missing required field: email"]
    assert got[1] == ["user_id must be a positive integer", "name must be a non-empty string", "Invalid email format: bad",
                      "Age cannot exceed 150", "Phone number must have at least 10 digits, got 3"]
    assert got[2] == []


def test_transactions(spark):
    as_of = datetime(2024, 1, 2)
    df = spark.createDataFrame([("t", 1.0, "USD", "2024-01-01T12:00:00Z"), ("t", 0.0, "XXX", "later"), ("t", 1.0, "IDR", "2024-01-03"), ("t", 1.0, "SGD", "2023-12-31T23:59:59"), ("t", None, "USD", "2024-01-01")],
                               "transaction_id string, amount double, currency string, timestamp string")
    got = [r[0] for r in df.select(clean.transaction_errors(as_of)).collect()]
    assert got == [[], ["amount must be positive", "currency must be one of USD, EUR, IDR, SGD", "timestamp must be valid ISO format"],
                   ["timestamp cannot be in the future"], ["timestamp must be within last 24 hours"], ["Missing required field: amount"]]


def test_cards(spark):
    as_of = datetime(2025, 6, 1)
    df = spark.createDataFrame([("4532-0151-1283-0366", "123", 6, 2025), ("4532015112830367", "12", 13, 2024), ("4111", "1234", 5, 2025)],
                               "card_number string, cvv string, expiry_month int, expiry_year int")
    got = [r[0] for r in df.select(clean.card_errors(as_of)).collect()]
    assert got == [[], ["Invalid card number (failed Luhn check)", "CVV must be 3 or 4 digits", "expiry_month must be 1-12", "Card has expired"],
                   ["Card number must be 13-19 digits", "Card has expired"]]


def test_names_and_passwords(spark):
    assert apply(spark, ["  john   DOE ", "x", None], clean.clean_name) == ["John Doe", None, None]
    assert apply(spark, ["Secret123", "short1A", "alllower1"], lambda c: F.size(clean.password_errors(c, c))) == [0, 1, 1]


def test_metal_payloads(spark):
    ddl = "p struct<timestamp:string,status:string,metals:map<string,double>,currency_base:string>"
    ok = ("2026-01-29T08:21:02.932Z", "success", {"gold": 178.0129, "lead": 1.0}, "USD")
    bad = [(ok[0], ok[1], {"gold": -100.0}, "USD"), (ok[0], ok[1], {"gold": 1.0}, None), (ok[0], ok[1], {"silver": None}, "USD"), (ok[0], ok[1], {}, "USD")]
    df = spark.createDataFrame([(ok,)] + [(b,) for b in bad], ddl)
    got = [r[0] for r in df.select(clean.metal_payload_errors(F.col("p"))).collect()]
    assert [len(g) for g in got] == [0, 1, 1, 1, 1]
    assert got[1] == ["metals: value must be greater than 0"] and got[4] == ["metals dictionary must not be empty"]
    assert df.select(clean.relevant_metals(F.col("p.metals"))).first()[0] == {"gold": 178.0129}


def test_weather(spark):
    raw = '{"current": {"time": "2024-01-01T10:00", "temperature_2m": 30.5, "precipitation": 1.9, "wind_speed_10m": 3, "relative_humidity_2m": 80, "apparent_temperature": 33, "weather_code": 63}}'
    df = spark.createDataFrame([("Jakarta", raw)], "city string, raw string")
    assert rows(clean.extract_weather(df, "raw")) == [("Jakarta", "2024-01-01T10:00", 30.5, 1.9, 3.0, 80.0, 33.0, "Hujan")]
    assert clean.extract_weather(df, "raw", truncate=True).first()["precipitation"] == 1
    labels = apply(spark, [0, 2, 4, 44, 45, 53, 85, 99, 100], columns.weather_label, "x int")
    assert labels == ["Cerah", "Sebagian Berawan", columns.WEATHER_UNKNOWN, columns.WEATHER_UNKNOWN, "Kabut", "Gerimis", "Salju", "Badai Petir", columns.WEATHER_UNKNOWN]


def test_trades_floor_millis(spark):
    df = spark.createDataFrame([('{"s": "BTC", "p": "1.5", "T": 1705318200999}',), ("broken",)], "raw string")
    assert rows(clean.parse_trades(df, "raw"), "symbol", "price", "event_time") == [("BTC", 1.5, 1705318200), (None, None, None)]


def test_silver_order(spark):
    df = spark.createDataFrame([("ORD-001", " CUST-123 ", "01/15/2024", "Completed", " 99.99 ")], "order_id string, customer_id string, order_date string, status string, total string")
    r = clean.standardise_orders(df, datetime(2024, 1, 15, 12)).first()
    assert (r["customer_id"], str(r["order_date"]), r["status"], r["total"]) == ("CUST-123", "2024-01-15", "COMPLETED", 99.99)


def test_envelope(spark):
    df = spark.createDataFrame([("success", None, None), ("error", None, "x"), ("odd", "d", None)], "status string, data string, error string")
    assert [len(r[0]) for r in df.select(clean.envelope_errors()).collect()] == [1, 0, 1]


def test_sanitize_keys(spark):
    from pyspark.sql import types as T

    inner = T.StructType([T.StructField("nested Key!", T.StringType())])
    schema = T.StructType([T.StructField("some-Key@", T.IntegerType()), T.StructField("another Key%", inner),
                           T.StructField("list/Key*", T.ArrayType(T.StructType([T.StructField("item#Key^", T.IntegerType())]))), T.StructField("1stKey", T.IntegerType())])
    out = reshape.sanitize_names(spark.createDataFrame([(1, ("v",), [(2,)], 3)], schema))
    assert out.columns == ["some_Key_", "another_Key_", "list_Key_", "_1stKey"]
    assert out.select("another_Key_.nested_Key_", F.col("list_Key_")[0]["item_Key_"]).first() == ("v", 2)
    with pytest.raises(ValueError, match="collide"):
        reshape.sanitize_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))


def test_bands(spark):
    got = apply(spark, [0, 18, 19, 30, 50, 51, 150, 151], lambda c: columns.cut(c, [0, 18, 30, 50, 150], ["a", "b", "c", "d"]), "x int")
    assert got == [None, "a", "b", "b", "c", "d", "d", None]
    assert apply(spark, [90.0, 89.9, 80.0, 70.0, 60.0, 59.9], columns.letter_grade, "x double") == ["A", "B", "B", "C", "D", "F"]


def test_event_pattern_on_nested_fields(spark):
    df = spark.createDataFrame([("bronze/orders/a.csv", 20), ("bronze/orders/a.json", 20), ("bronze/customers/a.csv", 20), ("bronze/orders/b.csv", 5), (None, 20)], "key string, size int")
    nested = df.select(F.struct(F.struct("key", "size").alias("object")).alias("detail"))
    pattern = {"detail": {"object": {"key": [{"prefix": "bronze/orders/", "suffix": ".csv"}], "size": [{"numeric": [">", 10]}]}}}
    assert [r[0] for r in nested.where(columns.event_pattern(pattern)).select("detail.object.key").collect()] == ["bronze/orders/a.csv"]
    either = {"detail": {"object": {"key": [{"suffix": ".csv"}, {"suffix": ".json"}]}}}
    assert nested.where(columns.event_pattern(either)).count() == 4


def test_masks(spark):
    assert apply(spark, ["john@shop.com"], columns.mask_email) == ["j***@shop.com"]
    assert apply(spark, ["+62-812-3456"], columns.redact_phone) == ["+**-***-**56"]
