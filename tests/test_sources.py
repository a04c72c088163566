from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.operators import dimensional as dims
from millrace.operators import upsert
from millrace.plans import flows
from millrace.sources import contracts, files, generate, html, kafka, sinks
from tests.conftest import rows

SALES = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DoubleType())])


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_modes(spark, tmp_path):
    path = write(tmp_path / "bad.csv", "id,amount\n1,2.5\nx,oops\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        files.read_csv_typed(spark, path, SALES).collect()
    got = files.read_csv_typed(spark, path, SALES, "PERMISSIVE").select("id", "_corrupt_record").collect()
    assert [tuple(r) for r in got] == [(1, None), (None, "x,oops")]


def test_csv_required(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,extra\n1,2\n")
    assert files.read_csv_required(spark, path, ["id"]).columns == ["id", "extra"]
    with pytest.raises(ValueError, match="Missing required columns: \\['amount'\\]"):
        files.read_csv_required(spark, path, ["id", "amount"])
    with pytest.raises(FileNotFoundError):
        files.read_csv_required(spark, str(tmp_path / "none.csv"), ["id"])


def test_json_ignores_unknown_fields(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"id": 1, "amount": 2.0, "new": true}\n')
    assert rows(files.read_json(spark, path, SALES)) == [(1, 2.0)]


def test_compact_and_export(spark, tmp_path):
    files.compact(spark.range(1000).repartition(16), str(tmp_path / "c"), 3)
    assert len(list((tmp_path / "c").glob("*.parquet"))) == 3
    with pytest.raises(ValueError, match="Unknown destination"):
        files.export(spark.range(1), str(tmp_path / "x"), "xlsx")


def test_partitioned_write_and_pruning(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).cast("int").alias("year"))
    files.write_partitioned(df, str(tmp_path / "p"), ["year"], ["id"])
    back = spark.read.parquet(str(tmp_path / "p")).where("year = 1")
    assert back.count() == 33
    assert "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().executedPlan().toString()


def test_dispositions(spark, tmp_path):
    path = str(tmp_path / "t")
    for mode, n in (("EMPTY", 5), ("APPEND", 10), ("TRUNCATE", 5)):
        files.load_with_disposition(spark.range(5), path, mode)
        assert spark.read.parquet(path).count() == n
    with pytest.raises(PySparkException):
        files.load_with_disposition(spark.range(5), path, "EMPTY")


def test_ledger_of_new_files(spark, tmp_path):
    source, ledger = tmp_path / "in", str(tmp_path / "ledger")
    write(source / "a.csv", "id\n1\n")
    first = files.new_file_paths(spark, str(source), ledger, "*.csv")
    first.select("path").write.parquet(ledger)
    write(source / "day2" / "b.csv", "id\n2\n")
    assert [r["path"].rsplit("/", 1)[1] for r in files.new_file_paths(spark, str(source), ledger, "*.csv").collect()] == ["b.csv"]


def test_register_table_finds_partitions(spark, tmp_path):
    spark.range(10).select("id", (F.col("id") % 2).alias("d")).write.partitionBy("d").parquet(str(tmp_path / "t"))
    table = files.register_table(spark, "registered_t", str(tmp_path / "t"))
    try:
        assert table.count() == 10 and spark.sql("SHOW PARTITIONS registered_t").count() == 2
    finally:
        spark.sql("DROP TABLE registered_t")


def test_generated_sales(spark):
    df = generate.generate_sales(spark, 2000, seed=1)
    r = df.agg(F.count("*"), F.min("transaction_id"), F.max("transaction_id"), F.min("amount"), F.max("amount"), F.min("quantity"), F.max("quantity"),
               F.min("date"), F.max("date"), F.avg((F.col("late_seconds") > 0).cast("int")), F.max("late_seconds")).first()
    assert r[:3] == (2000, "TXN000001", "TXN002000")
    assert 10 <= r[3] and r[4] <= 1000 and (r[5], r[6]) == (1, 9) and r[7] >= "2024-01-01" and r[8] <= "2024-12-31"
    assert 0.07 < r[9] < 0.13 and r[10] <= 480
    assert rows(df.limit(50)) == rows(generate.generate_sales(spark, 2000, seed=1).limit(50))


def test_contract_versions(spark):
    v2 = {"type": "record", "name": "Trade", "fields": [
        {"name": "symbol", "type": "string"}, {"name": "price", "type": "double"}, {"name": "event_time", "type": "long"},
        {"name": "volume", "type": "float", "default": 0.0}]}
    assert contracts.avsc_to_struct(v2).simpleString() == "struct<symbol:string,price:double,event_time:bigint,volume:float>"
    v1 = spark.createDataFrame([("BTC", "1.5", 10), ("ETH", "x", 11), (None, "2", 12)], "symbol string, price string, event_time long")
    got = [tuple(r) for r in contracts.enforce_contract(v1, v2).collect()]
    assert got == [("BTC", 1.5, 10, 0.0, []), ("ETH", None, 11, 0.0, ["price: wrong type"]), (None, 2.0, 12, 0.0, ["symbol: required"])]
    with pytest.raises(ValueError, match="price is missing"):
        contracts.enforce_contract(v1.drop("price"), v2)


def test_contract_types(spark):
    c = {"type": "record", "name": "R", "fields": [
        {"name": "phone", "type": ["null", "string"], "default": None}, {"name": "at", "type": "long", "logicalType": "timestamp-millis"},
        {"name": "day", "type": "int", "logicalType": "date"}, {"name": "tags", "type": {"type": "array", "items": "string"}},
        {"name": "status", "type": {"type": "enum", "name": "S", "symbols": ["PASS", "FAIL"]}}]}
    s = contracts.avsc_to_struct(c)
    assert s.simpleString() == "struct<phone:string,at:timestamp,day:date,tags:array<string>,status:string>" and s["phone"].nullable and not s["at"].nullable
    df = spark.createDataFrame([(1705318200000, date(2024, 1, 1), ["a"], "PASS"), (0, None, [], "ODD")], "at long, day date, tags array<string>, status string")
    got = contracts.enforce_contract(df, c).withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm")).collect()
    assert got[0]["at"] == "2024-01-15 11:30" and got[0]["phone"] is None and got[0]["errors"] == []
    assert got[1]["errors"] == ["day: required", "status: not in enum"]


def test_kafka_parsing_without_broker(spark):
    assert kafka.kafka_options("h:9092", "t", max_offsets=200) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "200"}
    raw = spark.createDataFrame([(bytearray(b'{"a": 1}'), datetime(2024, 1, 1))], "value binary, timestamp timestamp")
    assert kafka.parse_json_value(raw, "a int").select("a").first()[0] == 1


def test_html(spark):
    page = "<html><TITLE lang='x'> A &amp; <b>B</b> &lt;c&gt;\n</TITLE><h1 class=a>One</h1><h1>Two</h1></html>"
    df = spark.createDataFrame([(1, "u", page), (2, "u", "plain")], "page_id int, url string, html string")
    assert rows(html.extract_html_fields(df), "title", "heading") == [("", ""), ("A & B <c>", "One")]


def test_fan_out_reports_failures(spark, tmp_path):
    out = sinks.fan_out(spark.range(3), {"ok": lambda d: d.write.parquet(str(tmp_path / "ok")), "bad": lambda d: 1 / 0})
    assert out["ok"] is None and out["bad"].startswith("ZeroDivisionError")


class FakeSession:
    """Only what shared_dir looks at; the real setting cannot change in a running session."""

    def __init__(self, setting=None, master="yarn"):
        self.conf, self.sparkContext, self.master, self.made = self, self, master, None
        self.setting, self.applicationId = setting, "app-1"

    def get(self, _key, default=None):
        return self.setting or default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


def test_shared_dir_comes_from_the_session(spark):
    assert session.scratch_path(FakeSession("hdfs:///shared"), "x").startswith("hdfs:///shared/millrace/app-1/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession())
    assert session.shared_dir(spark) == session.shared_dir(spark)


# --- upserts and dimensions ------------------------------------------------------------------


def test_upsert_table_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "c")], "id int, v int, p string")
    upsert.upsert_table(spark, path, base, ["id", "p"], ["p"])
    before = {f.name for f in (tmp_path / "t" / "p=c").glob("*.parquet")}
    batch = spark.createDataFrame([(1, 9, "a"), (4, 4, "b")], "id int, v int, p string")
    for _ in range(2):
        upsert.upsert_table(spark, path, batch, ["id", "p"], ["p"])
        assert rows(spark.read.parquet(path), "id", "v", "p") == [(1, 9, "a"), (2, 1, "b"), (3, 2, "c"), (4, 4, "b")]
    assert {f.name for f in (tmp_path / "t" / "p=c").glob("*.parquet")} == before


def test_upsert_merge_rules(spark):
    cols = "k string, open int, high int, low int, close int"
    old, new = spark.createDataFrame([("a", 1, 5, 1, 2), ("b", 1, 1, 1, 1)], cols), spark.createDataFrame([("a", 9, 4, 0, 7), ("c", 3, 3, 3, 3)], cols)
    got = upsert.upsert_merge(old, new, ["k"], {"open": "old", "high": "greatest", "low": "least", "close": "new"})
    assert rows(got) == [("a", 1, 5, 0, 7), ("b", 1, 1, 1, 1), ("c", 3, 3, 3, 3)]


def test_incremental_into_empty_target_loads_all(spark):
    src = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "id int, ts timestamp_ntz")
    assert upsert.incremental_append(src.where("false"), src, "ts", ["id"], ["ts"]).count() == 2
    newer = upsert.newer_rows(src, src.where("id = 1"), "ts")
    assert rows(newer, "id") == [(1,), (2,)]  # more rows of the latest instant may have come


def test_scd2_keeps_history_and_null_safe_compare(spark):
    snap = lambda data: spark.createDataFrame(data, "id int, name string")
    d1 = dims.scd2_open(snap([(1, "a"), (2, None), (3, "c")]), ["id"], ["name"], datetime(2024, 1, 1))
    d2 = dims.scd2(d1, snap([(1, "b"), (2, None), (4, "d")]), ["id"], ["name"], datetime(2024, 2, 1))
    d3 = dims.scd2(d2, snap([(1, "c"), (2, "x")]), ["id"], ["name"], datetime(2024, 3, 1))
    got = rows(d3.select("id", "name", F.month("valid_from"), F.month("valid_to"), "is_current"))
    assert got == sorted([(1, "a", 1, 2, False), (1, "b", 2, 3, False), (1, "c", 3, None, True), (2, None, 1, 3, False), (2, "x", 3, None, True),
                          (3, "c", 1, None, True), (4, "d", 2, None, True)], key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
    assert d3.select("version_key").distinct().count() == 7
    again = dims.scd2(d3, snap([(1, "c"), (2, "x")]), ["id"], ["name"], datetime(2024, 4, 1))
    assert rows(again, "id", "name", "is_current") == rows(d3, "id", "name", "is_current")


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(dims.surrogate_key(["x", "y"])).collect()] + [df.select(dims.surrogate_key(["x"])).first()[0]]
    assert len(set(keys)) == 3


def test_schema_drift(spark):
    old = T.StructType.fromDDL("a int, b string, c float, d date")
    new = T.StructType.fromDDL("b string, a bigint, c int, e string")
    got = {(r["column"], r["change"]): r["verdict"] for r in dims.schema_drift(spark, old, new).collect()}
    assert got == {("a", "widened"): "safe", ("c", "changed"): "risky", ("d", "dropped"): "risky", ("e", "added"): "safe", ("*", "reordered"): "safe"}


def test_materialise_modes(spark):
    df = spark.range(10)
    assert dims.materialise(df, "m_view", "view").count() == 10
    assert dims.materialise(df, "x", "ephemeral") is df
    try:
        assert dims.materialise(df, "m_table", "table", ["id"], buckets=4).count() == 10
    finally:
        spark.sql("DROP TABLE IF EXISTS m_table")
    with pytest.raises(ValueError):
        dims.materialise(df, "x", "cube")


def test_all_sources_missing_fails(spark):
    with pytest.raises(ValueError, match="all sources"):
        dims.join_sections(spark, spark.range(1), "id", {"a": (None, "x int")})


# --- jobs --------------------------------------------------------------------------------------


def commodity_doc(spark, tmp_path, nickel=0.25):
    """A Tuesday's record: no news on silver, a yield series whose newest value is missing, and prices of tomorrow."""
    import json

    morning = "2025-03-04T06:15:00"
    series = {"DGS10": [("2025-02-28", "4.0"), ("2025-03-03", "4.5"), ("2025-03-04", ".")], "CPIAUCSL": [("2025-03-05", "320.0")]}
    macro = {name: {"count": len(seen), "observations": [{"date": d, "value": v} for d, v in seen]} for name, seen in series.items()}
    metals = {"gold": 90.0, "silver": 1.25, "platinum": 31.0, "nickel": nickel, "copper": 0.01}
    doc = {"timestamp": morning, "macro": json.dumps(macro), "news": {"timestamp": morning, "gold": 7, "platinum": 0, "nickel": 3, "copper": 11},
           "metals": {"status": "success", "timestamp": morning, "currency_base": "USD", "metals": metals},
           "currency": {"date": morning[:10], "base": "USD", "rates": {"IDR": 16000.0, "EUR": 0.5, "CNY": 8.0, "JPY": 100.0}}}
    return write(tmp_path / "raw" / "day.json", json.dumps(doc) + "\n")


def test_commodity_mart_of_one_document(spark, tmp_path):
    mart = flows.run_commodity_mart(spark, commodity_doc(spark, tmp_path), str(tmp_path / "out"))
    gold = mart.where("commodity_id = 'gold'").first()
    assert (gold["price"], gold["news_count"], gold["idr_price"]) == (90.0, 7, 1_440_000.0)
    assert (gold["treasury_yield_value"], str(gold["treasury_yield_date"])) == (4.5, "2025-03-03")
    assert gold["cpi_value"] is None
    assert mart.where("commodity_id = 'silver'").first()["news_count"] is None
    assert spark.read.parquet(str(tmp_path / "out" / "dim_commodity")).where("commodity_type = 'precious'").count() == 3
    assert rows(spark.read.parquet(str(tmp_path / "out" / "dim_macro_series")), "series_id", "series_name") == [
        ("CPIAUCSL", "Consumer Price Index"), ("DGS10", "10-Year Treasury Yield")]


def test_commodity_mart_refuses_a_missing_price(spark, tmp_path):
    with pytest.raises(ValueError, match="nickel_price"):
        flows.run_commodity_mart(spark, commodity_doc(spark, tmp_path, nickel=None), str(tmp_path / "out"))


def test_bronze_refuses_mostly_corrupt_amounts(spark, tmp_path):
    head = ",".join(flows.ORDER_COLUMNS)
    path = write(tmp_path / "o.csv", head + "\n1,1,2024-01-01,x,F,a,r\n2,1,2024-01-01,y,F,a,r\n3,1,bad,5.0,F,a,r\n,1,2024-01-01,1,F,a,r\n")
    with pytest.raises(ValueError, match="max_null_ratio"):
        flows.bronze_to_silver(spark, path, str(tmp_path / "out"))
    assert flows.bronze_to_silver(spark, path, str(tmp_path / "out"), 0.7).count() == 3


def test_shop_cleaning_totals(spark):
    raw = spark.createDataFrame([("  JohN@Example.COM  ", "Laptop", "$1,299.99", 1, "2024-01-15T10:30:00Z"), ("alice@test.com", "Mouse", "$29.99", 3, "2024-01-15T11:00:00Z"),
                                 ("BOB@SHOP.COM", "Laptop", "$1,299.99", 2, "1705318800000"), ("nobody", "Mouse", "$1", 1, "2024-01-15"), ("a@b.c", "Desk", "free", 1, "2024-01-15")],
                                "user_email string, product string, amount string, quantity int, timestamp string")
    assert rows(flows.clean_shop_sales(raw)) == [("Laptop", 1299.99 * 1 + 1299.99 * 2), ("Mouse", 29.99 * 3)]  # doubles, rounded once


def test_graded_scores(spark, tmp_path):
    scores = spark.createDataFrame([(1, "A", 95.0, datetime(2024, 1, 1)), (2, "B", 88.0, datetime(2024, 1, 1)), (3, "C", None, datetime(2024, 1, 1)), (4, "D", 87.0, datetime(2024, 1, 1))],
                                   "id int, name string, score double, created_at timestamp_ntz")
    for fmt in ("parquet", "csv", "json"):
        got = flows.graded_scores(scores, str(tmp_path / fmt), "b", datetime(2024, 2, 1), fmt)
        assert rows(got, "id", "score", "grade") == [(1, 95.0, "A"), (2, 88.0, "B"), (3, 90.0, "A"), (4, 87.0, "B")]
    with pytest.raises(ValueError, match="in_range"):
        flows.graded_scores(scores.withColumn("score", F.lit(101.0)), str(tmp_path / "x"), "b", datetime(2024, 2, 1))


def test_metal_quote_gate(spark):
    q = spark.createDataFrame([(1705318200, "XAU", "USD", "FX", "XAUUSD", 2000.0, 1990.0, 1991.0, 2010.0, 1980.0, 10.0, 0.5)],
                              "timestamp long, metal string, currency string, exchange string, symbol string, price double, prev_close_price double, open_price double, high_price double, low_price double, ch double, chp double")
    r = flows.metal_quotes(q, 16000.0, datetime(2024, 1, 16)).first()
    assert r["price_idr"] == 32_000_000.0 and str(r["timestamp"]) == "2024-01-15 11:30:00"
    with pytest.raises(ValueError, match="price_usd"):
        flows.metal_quotes(q.withColumn("price", F.lit(0.0)), 16000.0, datetime(2024, 1, 16))
    with pytest.raises(ValueError, match="exchange"):
        flows.metal_quotes(q.withColumn("exchange", F.lit(None).cast("string")), 16000.0, datetime(2024, 1, 16))


def test_contract_batch_fans_out(spark, tmp_path):
    batch = spark.createDataFrame([("BTC", 2.0, 1705318200), ("BTC", 4.0, 1705318300)], "symbol string, price double, event_time long")
    contract = {"type": "record", "name": "Trade", "fields": [{"name": "symbol", "type": "string"}, {"name": "price", "type": "double"},
                                                              {"name": "event_time", "type": "long"}, {"name": "volume", "type": "float", "default": 0.0}]}
    daily, done = flows.contract_batch(batch, contract, str(tmp_path / "o"))
    assert done == {"lake": None, "table": None, "warehouse": None}
    assert rows(daily) == [("BTC", date(2024, 1, 15), 3.0, 2.0, 4.0, 0.0, 2)]
