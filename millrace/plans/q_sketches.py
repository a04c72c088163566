"""Queries for sketches, keyword tables, and operators on the paths that split hot groups."""

from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import joins, mentions, sketches, windows
from millrace.plans.q_sources import drain, event_stream
from millrace.plans.q_tables import MONTHLY, sales_table
from millrace.plans.registry import ORACLES, query
from millrace.session import stage
from millrace.streaming import core as st

# --- distinct counts and quantiles from stored sketches -----------------------------------


def _near(estimate, exact):
    """Whether an estimate is within the stated error of the exact count (or within one, for small counts)."""
    return F.abs(estimate - F.col(exact)) <= F.greatest(F.lit(1.0), F.col(exact) * sketches.distinct_error())


def _kept(t):
    """Sketches of the users per day and event type, written once."""
    return stage(sketches.distinct_sketches(t.events, [F.to_date("ts").alias("day"), "event_type"], "user_id"), "sketches")


@query("a06_sketched_days", "SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY 1")
def _(t):
    days = sketches.merge_distinct(_kept(t), ["day"])
    exact = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("users"))
    return days.join(exact, "day").select("day", "users", _near(F.hll_sketch_estimate("sketch"), "users").alias("near"))


@query("a06_sketched_types", "SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY 1")
def _(t):
    kinds = sketches.merge_distinct(_kept(t), ["event_type"])
    exact = t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    return kinds.join(exact, "event_type").select("event_type", "users", _near(F.hll_sketch_estimate("sketch"), "users").alias("near"))


@query("a06_approx_checked", "SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY 1")
def _(t):
    """Beside an exact distinct count, Spark keeps the registers of the estimate per user and not per type, so each is counted by itself."""
    exact = t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    approx = t.events.groupBy(F.col("event_type").alias("_type")).agg(F.approx_count_distinct("user_id", 0.016).alias("approx"))
    both = exact.join(approx, F.col("event_type").eqNullSafe(F.col("_type")))
    return both.select("event_type", "users", _near(F.col("approx"), "users").alias("near"))


@query("s07_stream_sketches", "SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY 1")
def _(t):
    """A sketch per day and type kept by a stream, merged over the days afterwards."""
    live = st.user_sketches(event_stream(t), "event_time", "event_type", "user_id", "1 day")
    kept = drain(t, live, ["window_start", "event_type"])
    exact = t.events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    merged = sketches.merge_distinct(kept, ["event_type"], "users_sketch")
    return merged.join(exact, "event_type").select("event_type", "users", _near(F.hll_sketch_estimate("users_sketch"), "users").alias("near"))


@query("a20_sketched_quantiles", """
SELECT l_returnflag, prob, true AS near FROM (SELECT DISTINCT l_returnflag FROM lineitem), (VALUES (0.05), (0.25), (0.5), (0.75), (0.99)) v(prob)
""")
def _(t):
    """Quantiles of merged monthly sketches, each held against its exact rank over all rows."""
    lines = t.lineitem.withColumn("month", F.trunc(F.to_date("l_shipdate"), "month"))
    monthly = stage(sketches.quantile_sketches(lines, ["l_returnflag", "month"], "l_extendedprice"), "sketches")
    merged = stage(sketches.merge_quantiles(monthly, ["l_returnflag"]), "merged")
    probs = (0.05, 0.25, 0.5, 0.75, 0.99)
    pairs = F.inline(F.array(*[F.struct(F.lit(p).alias("prob"), sketches.quantile("sketch", p).alias("mark")) for p in probs]))
    marks = stage(merged.select("l_returnflag", pairs), "marks")
    ranks = sketches.true_ranks(t.lineitem, ["l_returnflag"], "l_extendedprice", marks, "mark")
    error = sketches.rank_error()
    return ranks.select("l_returnflag", "prob", ((F.col("below") <= F.col("prob") + error) & (F.col("upto") >= F.col("prob") - error)).alias("near"))


# --- a table of keywords ------------------------------------------------------------------

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '')"


@query("a19_keyword_table", rf"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
k AS (SELECT DISTINCT unnest(w) AS keyword FROM b UNION SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM b),
m AS (SELECT DISTINCT doc_id, unnest(w) AS keyword FROM d UNION SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d)
SELECT keyword, count(doc_id) AS documents FROM k LEFT JOIN m USING (keyword) GROUP BY 1
""")
def _(t):
    """Every word and every pair of adjacent words of the benchmark as a keyword."""
    words = t.benchmark.select(mentions.words_of("text").alias("w"))
    pairs = F.expr("filter(transform(w, (x, i) -> concat(x, ' ', get(w, i + 1))), x -> x IS NOT NULL)")
    table = words.select(F.explode(F.concat("w", pairs)).alias("keyword")).distinct()
    return mentions.keyword_mentions(t.documents, "doc_id", "text", table, "keyword")


# --- hot groups: the same answers on the paths that split them -----------------------------


def _piece(rows):
    """A limit that makes groups with a fifth of the rows hot: about twenty runs in all, at every size."""
    return max(1, rows.count() // 20)


def _by_type(name):
    """The check of a window per user, per event type."""
    return ORACLES[name].replace("user_id", "event_type")


@query("j08_asof_join_split", """
WITH e AS (SELECT ts, max(value) AS value FROM events WHERE event_type = 'error' GROUP BY 1), p AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'error')
SELECT event_id, p.user_id, p.ts, e.value AS last_error, e.ts AS error_ts FROM p ASOF LEFT JOIN e ON p.ts >= e.ts
""")
def _(t):
    errors = t.events.where("event_type = 'error'").groupBy("ts").agg(F.max("value").alias("value"))
    others = t.events.where("event_type <> 'error'").select("event_id", "user_id", "ts")
    return joins.asof_join(others, errors, "ts", "ts", [], {"value": "last_error", "ts": "error_ts"}, max_group_rows=_piece(others))


@query("j11_salted_join_hot", ORACLES["j11_salted_join"])
def _(t):
    kinds = t.events.groupBy("event_type").agg(agg.exact_avg("value").alias("avg_value"))
    return joins.salted_join(t.events.select("event_id", "event_type", "value"), kinds, "event_type", ["event_id"], max_key_rows=_piece(t.events))


@query("j12_split_skew_join_hot", ORACLES["j12_split_skew_join"])
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.split_skew_join(lines, parts, "l_partkey", ["l_orderkey", "l_linenumber", "l_suppkey"], max_key_rows=20)


@query("w02_rank_split", f"WITH {MONTHLY} SELECT *, rank() OVER (PARTITION BY year ORDER BY total_revenue DESC) AS region_rank FROM monthly")
def _(t):
    monthly = stage(agg.monthly_sales(sales_table(t)), "monthly")
    return windows.rank_in_group(monthly, ["year"], "total_revenue", "region_rank", max_group_rows=_piece(monthly))


def _ticks(t):
    return t.events.select("event_id", "event_type", "ts", "value")


@query("w03_running_total_split", _by_type("w03_running_total"))
def _(t):
    out = windows.running_total(_ticks(t), ["event_type"], ["ts", "event_id"], F.col("value"), "running", max_group_rows=_piece(t.events))
    return out.select("event_id", "event_type", F.col("running").cast("double").alias("running"))


@query("w04_row_number_split", _by_type("w04_row_number_per_user"))
def _(t):
    return windows.row_numbers(_ticks(t).drop("value"), ["event_type"], ["ts", "event_id"], max_group_rows=_piece(t.events)).select(
        "event_id", "event_type", F.col("rn").cast("bigint").alias("rn"))


@query("w05_lag_lead_split", _by_type("w05_lag_lead"))
def _(t):
    return windows.lag_lead(_ticks(t), ["event_type"], ["ts", "event_id"], "value", "prev_value", "next_value", max_group_rows=_piece(t.events)).drop("ts")


@query("w08_moving_average_split", ORACLES["w08_moving_average"])
def _(t):
    e = t.events.select("event_id", "event_type", "ts", "value")
    return windows.moving_average(e, ["event_type"], "ts", F.col("value").cast("decimal(18,2)"), 3600, "avg_1h", max_group_rows=_piece(t.events)).select("event_id", "avg_1h")


@query("w10_locf_split", _by_type("w10_locf_fill"))
def _(t):
    sparse = t.events.select("event_id", "event_type", "ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))
    return windows.locf(sparse, ["event_type"], ["ts", "event_id"], "value", "filled", max_group_rows=_piece(t.events)).select("event_id", "event_type", "filled")


@query("a20_iqr_bounds_split", ORACLES["a20_iqr_bounds"])
def _(t):
    bounds = agg.iqr_bounds(t.lineitem, ["l_returnflag"], "l_extendedprice", max_group_rows=_piece(t.lineitem))
    return bounds.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("q1", "q3", "lower", "upper")])
