"""Queries for the data-quality rules."""

from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.plans.registry import query
from millrace.session import stage

COLUMNS = '"check", "column", severity, passed, failed_rows, total_rows, detail'


def row(check, column, failed, total, detail="NULL", severity="error", passed=None):
    """SQL of one report row over a FROM clause that follows."""
    passed = passed or f"({failed}) = 0"
    return (f"SELECT '{check}' AS \"check\", '{column}' AS \"column\", '{severity}' AS severity, {passed} AS passed, "
            f"CAST({failed} AS BIGINT) AS failed_rows, CAST({total} AS BIGINT) AS total_rows, CAST({detail} AS VARCHAR) AS detail")


@query("q01_not_null", "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey FROM orders) "
       + row("not_null", "o_orderkey", "count(*) - count(o_orderkey)", "count(*)") + " FROM o UNION ALL "
       + row("not_null", "o_custkey", "count(*) - count(o_custkey)", "count(*)") + " FROM o UNION ALL "
       + row("not_null", "o_missing", "NULL", "count(*)", "'column not found: o_missing'", passed="false") + " FROM o")
def _(t):
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"))
    return q.run_checks(o, [q.not_null("o_orderkey"), q.not_null("o_custkey"), q.not_null("o_missing")])


@query("q02_no_duplicates", row("no_duplicates", "l_orderkey,l_linenumber", "sum(n - 1)", "sum(n)") + " FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def _(t):
    return q.run_checks(t.lineitem, [q.no_duplicates(["l_orderkey", "l_linenumber"])])


@query("q03_unique", row("unique", "o_orderkey", "count(*) - count(DISTINCT o_orderkey)", "count(*)") + " FROM orders UNION ALL "
       + row("unique", "o_custkey", "count(*) - count(DISTINCT CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END)", "count(*)") + " FROM orders UNION ALL "
       + row("unique", "status-date", "count(*) - count(DISTINCT o_orderstatus || '-' || CAST(o_orderdate AS DATE))", "count(*)") + " FROM orders")
def _(t):
    o = t.orders.withColumn("o_custkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")))
    composite = F.concat("o_orderstatus", F.lit("-"), F.to_date("o_orderdate").cast("string"))
    return q.run_checks(o, [q.unique("o_orderkey"), q.unique("o_custkey"), q.unique(composite, "status-date")])


@query("q04_in_range", row("in_range", "l_discount", "count(*) FILTER (l_discount < 0.02 OR l_discount > 0.08)", "count(*)",
       "'below=' || count(*) FILTER (l_discount < 0.02) || ' above=' || count(*) FILTER (l_discount > 0.08)") + " FROM lineitem UNION ALL "
       + row("in_range", "l_quantity", "count(*) FILTER (l_quantity <= 1 OR l_quantity >= 50)", "count(*)",
       "'below=' || count(*) FILTER (l_quantity <= 1) || ' above=' || count(*) FILTER (l_quantity >= 50)") + " FROM lineitem")
def _(t):
    return q.run_checks(t.lineitem, [q.in_range("l_discount", 0.02, 0.08), q.in_range("l_quantity", 1, 50, strict=True)])


@query("q05_types", row("types", "o_orderkey,o_orderdate,o_totalprice", "NULL", "count(*)", "'o_totalprice should be string, is double'", passed="false") + " FROM orders")
def _(t):
    return q.run_checks(t.orders, [q.types({"o_orderkey": "numeric", "o_orderdate": "datetime", "o_totalprice": "string"})])


@query("q06_referential_integrity", row("references", "doc_id", "0", "count(*)", "''") + " FROM labels UNION ALL "
       + row("references", "doc_id", "(SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id))", "count(*)",
       "(SELECT array_to_string(list_sort(list(CAST(doc_id AS VARCHAR))), ', ') FROM (SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id) ORDER BY doc_id LIMIT 10))") + " FROM documents")
def _(t):
    forward = q.run_checks(t.labels, [q.references("doc_id", t.documents.select("doc_id"), "doc_id")])
    return forward.unionByName(q.run_checks(t.documents, [q.references("doc_id", t.labels, "doc_id")]))


@query("q06_orphan_values", "SELECT doc_id AS value, count(*) AS rows FROM documents ANTI JOIN labels USING (doc_id) GROUP BY 1")
def _(t):
    return q.orphan_values(t.documents.select("doc_id"), "doc_id", t.labels, "doc_id")


@query("q07_freshness", """
WITH a AS (SELECT count(*) AS n, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 3600000000 AS newest,
  (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(min(ts))) / 3600000000 AS oldest FROM events)
SELECT 'fresh_newest' AS "check", 'warn' AS severity, newest <= 48 AS passed, n AS total_rows, round(newest, 6) AS hours FROM a
UNION ALL SELECT 'fresh_oldest', 'error', oldest <= 24, n, round(oldest, 6) FROM a
""")
def _(t):
    as_of = datetime(2024, 1, 31)
    report = q.run_checks(t.events, [q.fresh("ts", as_of, 48).warn(), q.fresh("ts", as_of, 24, mode="oldest")])
    return report.select("check", "severity", "passed", "total_rows", F.round(F.col("detail").cast("double"), 6).alias("hours"))


@query("q08_patterns", row("matches", "c_name", "count(*) FILTER (NOT regexp_matches(c_name, '^Customer#[0-9]+[02468]$'))", "count(*)") + " FROM customer UNION ALL "
       + row("starts_with", "c_name", "count(*) FILTER (NOT starts_with(c_name, 'Customer#00000000'))", "count(*)") + " FROM customer UNION ALL "
       + row("min_length", "c_mktsegment", "count(*) FILTER (length(c_mktsegment) < 9)", "count(*)") + " FROM customer UNION ALL "
       + row("is_in", "c_mktsegment", "count(*) FILTER (c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY'))", "count(*)") + " FROM customer")
def _(t):
    return q.run_checks(t.customer, [q.matches("c_name", "^Customer#[0-9]+[02468]$"), q.starts_with("c_name", "Customer#00000000"),
                                     q.min_length("c_mktsegment", 9), q.is_in("c_mktsegment", ["HOUSEHOLD", "MACHINERY"])])


@query("q09_strict_columns", row("strict_columns", "r_regionkey,r_label", "NULL", "count(*)", "'r_label not found; r_name is not expected'", passed="false") + " FROM region UNION ALL "
       + row("columns_present", "r_regionkey", "NULL", "count(*)", passed="true") + " FROM region")
def _(t):
    return q.run_checks(t.region, [q.columns_present(["r_regionkey", "r_label"], strict=True), q.columns_present(["r_regionkey"])])


@query("q10_cross_column", row("discounted_le_original", "l_extendedprice,l_discount", "count(*) FILTER (l_extendedprice * (1 - l_discount) > l_extendedprice)", "count(*)") + " FROM lineitem UNION ALL "
       + row("tax_gt_discount", "l_tax,l_discount", "count(*) FILTER (NOT l_tax > l_discount)", "count(*)") + " FROM lineitem UNION ALL "
       + row("price_gt_quantity", "l_extendedprice,l_quantity", "count(*) FILTER (NOT l_extendedprice > l_quantity * 1000)", "count(*)") + " FROM lineitem")
def _(t):
    price, disc = F.col("l_extendedprice"), F.col("l_discount")
    return q.run_checks(t.lineitem, [
        q.holds("discounted_le_original", ["l_extendedprice", "l_discount"], price * (1 - disc) <= price),
        q.holds("tax_gt_discount", ["l_tax", "l_discount"], F.col("l_tax") > disc),
        q.holds("price_gt_quantity", ["l_extendedprice", "l_quantity"], price > F.col("l_quantity") * 1000)])


@query("q11_statistical", """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'mean_between' AS "check", avg(value) BETWEEN 20 AND 80 AS passed, NULL AS failed_rows, count(*) AS total_rows FROM events
UNION ALL SELECT 'no_outliers', count(*) FILTER (value NOT BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)) = 0,
  count(*) FILTER (value NOT BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1)), count(*) FROM events, b
""")
def _(t):
    report = q.run_checks(t.events, [q.mean_between("value", 20, 80), q.no_outliers("value")])
    return report.select("check", "passed", "failed_rows", "total_rows")


@query("q12_custom_columns", row("lowercase", "event_type", "0", "count(*)") + " FROM events UNION ALL "
       + row("no_weekend", "ts", "count(*) FILTER (isodow(ts) > 5)", "count(*)") + " FROM events")
def _(t):
    return q.run_checks(t.events, [q.lowercase("event_type"), q.no_weekend("ts")])


@query("q13_schema_inheritance", row("not_null", "c_custkey", "0", "count(*)") + " FROM customer UNION ALL "
       + row("in_range", "c_acctbal", "count(*) FILTER (c_acctbal < 0)", "count(*)", "'below=' || count(*) FILTER (c_acctbal < 0) || ' above=0'") + " FROM customer")
def _(t):
    base = [q.not_null("c_custkey")]
    return q.run_checks(t.customer, base + [q.in_range("c_acctbal", low=0)])


def _dirty(t):
    k = F.col("o_orderkey")
    return t.orders.select("o_orderkey", F.when(k % 17 == 0, None).otherwise(F.col("o_custkey")).alias("o_custkey"),
                           F.when(k % 13 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                           F.when(k % 11 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("o_totalprice"))


DIRTY = """
d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 11 = 0 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders)
"""


def _rules():
    return [q.not_null("o_custkey"), q.is_in("o_orderstatus", ["F", "O", "P"]), q.in_range("o_totalprice", low=0)]


@query("q14_failure_cases", f"""
WITH {DIRTY} SELECT o_orderkey, 'o_custkey' AS "column", 'not_null' AS "check", CAST(NULL AS VARCHAR) AS failure_case FROM d WHERE o_custkey IS NULL
UNION ALL SELECT o_orderkey, 'o_orderstatus', 'is_in', o_orderstatus FROM d WHERE o_orderstatus = 'X'
UNION ALL SELECT o_orderkey, 'o_totalprice', 'in_range', CAST(o_totalprice AS VARCHAR) FROM d WHERE o_totalprice < 0
""")
def _(t):
    return q.failure_cases(_dirty(t), _rules(), ["o_orderkey"])


@query("q15_split_valid", f"""
WITH {DIRTY} SELECT o_orderkey, 'valid' AS outcome, '' AS errors FROM d WHERE o_custkey IS NOT NULL AND o_orderstatus <> 'X' AND o_totalprice >= 0
UNION ALL SELECT o_orderkey, 'rejected', concat_ws('; ', CASE WHEN o_custkey IS NULL THEN 'not_null(o_custkey)' END, CASE WHEN o_orderstatus = 'X' THEN 'is_in(o_orderstatus)' END,
  CASE WHEN o_totalprice < 0 THEN 'in_range(o_totalprice)' END) FROM d WHERE o_custkey IS NULL OR o_orderstatus = 'X' OR o_totalprice < 0
""")
def _(t):
    good, bad = q.split_valid(q.with_errors(_dirty(t), _rules()))
    kept = good.select("o_orderkey", F.lit("valid").alias("outcome"), F.lit("").alias("errors"))
    return kept.unionByName(bad.select("o_orderkey", F.lit("rejected").alias("outcome"), F.array_join("errors", "; ").alias("errors")))


@query("q15_reject_batch", f"WITH {DIRTY} SELECT 0 AS accepted, count(*) AS rejected FROM d")
def _(t):
    good, bad = q.split_valid(q.with_errors(_dirty(t), _rules()), policy="batch")
    counts = good.select(F.lit(1).alias("ok")).unionByName(bad.select(F.lit(0).alias("ok")))
    return counts.agg(F.count_if(F.col("ok") == 1).alias("accepted"), F.count_if(F.col("ok") == 0).alias("rejected"))


@query("q16_corrupted_ratio", """
WITH c AS (SELECT TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN 'bad' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS amount, TRY_CAST(CASE WHEN o_orderkey % 3 <> 0 THEN 'bad' ELSE '1' END AS DOUBLE) AS amount2 FROM orders)
SELECT 'amount' AS "column", (count(*) - count(amount)) / count(*) <= 0.5 AS passed, count(*) AS total_rows FROM c
UNION ALL SELECT 'amount2', (count(*) - count(amount2)) / count(*) <= 0.5, count(*) FROM c
""")
def _(t):
    k = F.col("o_orderkey") % 3
    c = t.orders.select(F.when(k == 0, "bad").otherwise(F.col("o_totalprice").cast("string")).try_cast("double").alias("amount"),
                        F.when(k != 0, "bad").otherwise("1").try_cast("double").alias("amount2"))
    return q.run_checks(c, [q.max_null_ratio("amount", 0.5), q.max_null_ratio("amount2", 0.5)]).select("column", "passed", "total_rows")


@query("q17_row_count_gate", row("rows_between", "*", "NULL", "count(*)", "count(*)", passed="count(*) >= 10") + " FROM nation UNION ALL "
       + row("rows_between", "*", "NULL", "count(*)", "count(*)", passed="count(*) BETWEEN 3 AND 10") + " FROM nation")
def _(t):
    return q.run_checks(t.nation, [q.rows_between(10), q.rows_between(3, 10)])


@query("q18_gate_decorators", "SELECT user_id, EXACT_SUM(value) AS total_spent FROM events GROUP BY 1")
def _(t):
    from millrace.operators.aggregates import exact_sum

    @q.check_input(q.not_null("user_id"), q.in_range("value", low=0))
    @q.check_output(q.in_range("total_spent", low=0), q.unique("user_id"))
    def spending(events):
        return events.groupBy("user_id").agg(exact_sum("value").alias("total_spent"))

    return spending(t.events)


@query("q19_suite_summary", f"WITH {DIRTY} SELECT 4 AS total_checks, 1 AS passed_checks, 2 AS failed_checks, 1 AS warnings, false AS suite_passed FROM d HAVING count(*) > 0")
def _(t):
    custkey, status, price = _rules()
    return q.summary(q.run_checks(_dirty(t), [custkey, status.warn(), price, q.not_null("o_orderkey")]))


@query("q20_severity", f"WITH {DIRTY} " + row("is_in", "o_orderstatus", "count(*) FILTER (o_orderstatus = 'X')", "count(*)", severity="warn") + " FROM d")
def _(t):
    dirty = _dirty(t)
    rules = [_rules()[1].warn()]
    return q.run_checks(q.enforce(dirty, rules), rules)


@query("q21_required_fields", " UNION ALL ".join(
    row("not_null", c, f"count(*) - count({c})", "count(*)") + " FROM part" for c in ("p_partkey", "p_name", "p_brand", "p_type")) + " UNION ALL "
    + row("in_range", "p_retailprice", "count(*) FILTER (p_retailprice <= 0)", "count(*)", "'below=' || count(*) FILTER (p_retailprice <= 0) || ' above=0'") + " FROM part")
def _(t):
    rules = [q.not_null(c) for c in ("p_partkey", "p_name", "p_brand", "p_type")] + [q.in_range("p_retailprice", low=0, strict=True)]
    return q.run_checks(t.part, rules)


@query("q22_report_table", f"""
WITH {DIRTY} SELECT 'b1' AS batch_id, 'not_null:o_custkey' AS metric_name, CAST(count(*) FILTER (o_custkey IS NULL) AS DOUBLE) AS metric_value, 'FAIL' AS status, TIMESTAMP '2024-02-01 00:00:00' AS checked_at FROM d
UNION ALL SELECT 'b1', 'is_in:o_orderstatus', CAST(count(*) FILTER (o_orderstatus = 'X') AS DOUBLE), 'WARN', TIMESTAMP '2024-02-01 00:00:00' FROM d
UNION ALL SELECT 'b1', 'not_null:o_orderkey', 0.0, 'PASS', TIMESTAMP '2024-02-01 00:00:00' FROM d HAVING count(*) > 0
""")
def _(t):
    custkey, status, _price = _rules()
    report = q.run_checks(_dirty(t), [custkey, status.warn(), q.not_null("o_orderkey")])
    return q.report_table(report, "b1", datetime(2024, 2, 1))


@query("q22_batch_metadata", """
SELECT 'b1' AS batch_id, 'daily' AS dag_id, DATE '2024-02-01' AS run_date, TIMESTAMP '2024-02-01 00:00:00' AS start_time, TIMESTAMP '2024-02-01 00:05:00' AS end_time, count(*) AS record_count, 'SUCCESS' AS status FROM events
""")
def _(t):
    return q.batch_metadata(t.events, "b1", "daily", "2024-02-01", datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 5), "SUCCESS")


@query("q23_observed_metrics", f"WITH {DIRTY} SELECT 'silver' AS step, count(*) AS rows_in, count(*) FILTER (o_totalprice < 0) AS rejected, count(*) FILTER (o_totalprice >= 0) AS rows_out FROM d")
def _(t):
    seen_df, seen = q.observed(_dirty(t), "silver", F.col("o_totalprice") < 0)
    out = stage(seen_df.where("o_totalprice >= 0"), "observed")
    counts = seen.get
    return out.agg(F.count(F.lit(1)).alias("rows_out")).select(
        F.lit("silver").alias("step"), F.lit(counts["rows_in"]).alias("rows_in"), F.lit(counts["rejected"]).alias("rejected"), "rows_out")


@query("q24_reconcile", """
WITH s AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01'), g AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2001-05-01' UNION ALL SELECT o_orderkey FROM orders WHERE o_totalprice > 490000),
c AS (SELECT coalesce(s.o_orderkey, g.o_orderkey) AS o_orderkey, coalesce(sn, 0) AS source_rows, coalesce(gn, 0) AS target_rows
  FROM (SELECT o_orderkey, count(*) AS sn FROM s GROUP BY 1) s FULL JOIN (SELECT o_orderkey, count(*) AS gn FROM g GROUP BY 1) g ON s.o_orderkey = g.o_orderkey)
SELECT *, CASE WHEN target_rows = 0 THEN 'missing_in_target' WHEN source_rows = 0 THEN 'extra_in_target' ELSE 'count_differs' END AS finding FROM c WHERE source_rows <> target_rows
""")
def _(t):
    target = t.orders.where("o_orderdate < '2001-05-01'").unionByName(t.orders.where("o_totalprice > 490000"))
    return q.reconcile(t.orders.where("o_orderdate >= '1995-03-01'"), target, ["o_orderkey"])
