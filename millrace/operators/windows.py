"""Window analytics (W01-W10) that stay exact and balanced when one group holds most rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.sums import fold, parts
from millrace.operators.runs import RUN, by_group_size, large_groups, last_value, sum_value, with_carry

MAX_QUANTILE_ROWS = 1_000_000


def dedup_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row of each key by a total order.

    ``row_number() = 1`` lets Spark cut each key to one row before the shuffle
    (WindowGroupLimit), so a key with many copies costs one row per input task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, name: str = "rank") -> DataFrame:
    """Rows whose ``rank()`` in the group is at most ``n`` (ties share a rank)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.rank().over(w)).where(F.col(name) <= n)


def rank_in_group(df: DataFrame, keys: Sequence[str], by: str, name: str = "rank", descending: bool = True,
                  max_group_rows: int | None = None) -> DataFrame:
    """``rank()`` within the group.

    For a large group the rank is 1 + the rows with a better value, counted over the distinct
    values only, so a value shared by many rows is one row in the ordered step.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()

    def plain(rows):
        return rows.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))

    large = large_groups(df, keys, max_group_rows)
    if large is None:
        return plain(df)
    counts = large.rows.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("_n"))
    sums = running_total(counts, keys, [by], F.col("_n"), "_upto", max_group_rows)
    if descending:
        totals = large.rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
        sums = _join_null_safe(sums, totals, keys).withColumn("_r", F.col("_all") - F.col("_upto") + 1)
    else:
        sums = sums.withColumn("_r", F.col("_upto") - F.col("_n") + 1)
    ranked = _join_null_safe(large.rows, sums.select(*keys, by, F.col("_r").cast("bigint").alias(name)), [*keys, by])
    return ranked if large.rest is None else ranked.unionByName(plain(large.rest))


def _join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    renamed = right.select(*[F.col(k).alias(f"_on{i}") for i, k in enumerate(on)],
                           *[c for c in right.columns if c not in on])
    cond = F.lit(True)
    for i, k in enumerate(on):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_on{i}"))
    return left.join(renamed, cond, how).drop(*[f"_on{i}" for i in range(len(on))])


def _window(keys: Sequence[str], order: Sequence[str], in_run: bool = False):
    return Window.partitionBy(*keys, *([RUN] if in_run else [])).orderBy(*order)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                max_group_rows: int | None = None) -> DataFrame:
    def plain(rows):
        return rows.withColumn(name, F.row_number().over(_window(keys, order)).cast("bigint"))

    def split(rows):
        local = F.row_number().over(_window(keys, order, True))
        return with_carry(rows, keys, F.count(F.lit(1)), sum_value).withColumn(
            name, local + F.coalesce("_carry", F.lit(0).cast("bigint"))).drop("_carry")

    return by_group_size(df, keys, order, max_group_rows, None, plain, split)


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column],
                   max_group_rows: int | None = None, sizes: tuple[int, int] | None = None) -> DataFrame:
    """Sums from the start of the group to the current row, one per named value.

    Doubles are summed in limbs, so plain and split totals are the same to the last bit.
    """
    doubles = [n for n, v in values.items() if df.select(v.alias("v")).schema["v"].dataType.typeName() in ("double", "float")]
    limbs = {n: {f"_{n}_{i}": p for i, p in enumerate(parts(values[n]))} for n in doubles}
    plain = {n: v for n, v in values.items() if n not in doubles}
    out = _running_sums(df, keys, order, reduce(or_, limbs.values(), plain), max_group_rows, sizes)
    totals = {n: fold([F.col(f"`{c}`") for c in own]) for n, own in limbs.items()}
    return out.withColumns(totals).drop(*[c for own in limbs.values() for c in own])


def _running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, Column],
                  max_group_rows: int | None, sizes: tuple[int, int] | None) -> DataFrame:
    def upto(value, in_run):
        return F.sum(value).over(_window(keys, order, in_run).rowsBetween(Window.unboundedPreceding, 0))

    def plain(rows):
        return rows.withColumns({n: upto(v, False) for n, v in values.items()})

    def split(rows):
        sums = F.struct(*[F.sum(v).alias(n) for n, v in values.items()])
        carried = with_carry(rows, keys, sums, lambda s, earlier: F.struct(*[F.sum(s[n]).over(earlier).alias(n) for n in values]))
        local = carried.withColumns({n: upto(v, True) for n, v in values.items()})

        def both(n):
            mine, before = F.col(n), F.col(f"_carry.{n}")
            total = F.when(before.isNull(), mine).when(mine.isNull(), before).otherwise(mine + before)
            return total.cast(local.schema[n].dataType)

        return local.withColumns({n: both(n) for n in values}).drop("_carry")

    return by_group_size(df, keys, order, max_group_rows, sizes, plain, split)


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str,
                  max_group_rows: int | None = None) -> DataFrame:
    """Sum of ``value`` from the start of the group to the current row."""
    return running_totals(df, keys, order, {name: value}, max_group_rows)


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Mapping[str, Column | str],
              previous: bool = True, max_group_rows: int | None = None, sizes: tuple[int, int] | None = None) -> DataFrame:
    """Add columns taken from the previous (or next) row of the group.

    ``cols`` maps each new name to an expression evaluated on the neighbour row.
    """
    picked = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in cols.items()])
    step, edge_of = (F.lag, F.max_by) if previous else (F.lead, F.min_by)

    def plain(rows):
        return rows.withColumn("_near", step(picked).over(_window(keys, order)))

    def split(rows):
        near = step(picked).over(_window(keys, order, True))
        carried = with_carry(rows, keys, edge_of(picked, F.struct(*order)), last_value, forward=previous)
        # _near is NULL only on the first (last) row of a run: a picked struct is never NULL.
        return carried.withColumn("_near", F.coalesce(near, F.col("_carry"))).drop("_carry")

    out = by_group_size(df, keys, order, max_group_rows, sizes, plain, split)
    return out.select("*", *[F.col(f"_near.{n}").alias(n) for n in cols]).drop("_near")


def lag_lead(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, prev: str, nxt: str,
             max_group_rows: int | None = None) -> DataFrame:
    """Previous and next value of ``col`` in the group."""

    def plain(rows):
        w = _window(keys, order)
        return rows.withColumns({prev: F.lag(col).over(w), nxt: F.lead(col).over(w)})

    def split(rows):
        # The row before and after also goes by run, so both looks share one cut.
        w, pos, first_last = _window(keys, order, True), F.struct(*order), F.struct(F.col(col).alias("v"))
        back = with_carry(rows, keys, F.max_by(first_last, pos), last_value).withColumnRenamed("_carry", "_b")
        ahead = with_carry(back, keys, F.min_by(first_last, pos), last_value, forward=False)
        return ahead.withColumns({
            prev: F.when(F.lag(F.lit(1)).over(w).isNull(), F.col("_b.v")).otherwise(F.lag(col).over(w)),
            nxt: F.when(F.lead(F.lit(1)).over(w).isNull(), F.col("_carry.v")).otherwise(F.lead(col).over(w)),
        }).drop("_b", "_carry")

    return by_group_size(df, keys, order, max_group_rows, None, plain, split)


def locf(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
         max_group_rows: int | None = None, sizes: tuple[int, int] | None = None) -> DataFrame:
    """Last non-NULL ``value`` at or before the row within the group."""

    def newest(in_run):
        return F.last(value, ignorenulls=True).over(_window(keys, order, in_run).rowsBetween(Window.unboundedPreceding, 0))

    def split(rows):
        last = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
        return with_carry(rows, keys, last, last_value).withColumn(name, F.coalesce(newest(True), F.col("_carry"))).drop("_carry")

    return by_group_size(df, keys, order, max_group_rows, sizes, lambda rows: rows.withColumn(name, newest(False)), split)


def drop_repeats(df: DataFrame, keys: Sequence[str], order: Sequence[str], fingerprint: Column,
                 max_group_rows: int | None = None) -> DataFrame:
    """Drop a row whose fingerprint equals that of the row before it in the group."""
    marked = df.withColumn("_fp", fingerprint)
    prev = neighbour(marked, keys, order, {"_prev_fp": "_fp", "_has_prev": F.lit(True)}, True, max_group_rows)
    repeat = F.coalesce(F.col("_has_prev"), F.lit(False)) & F.col("_fp").eqNullSafe(F.col("_prev_fp"))
    return prev.where(~repeat).drop("_fp", "_prev_fp", "_has_prev")


def price_alerts(df: DataFrame, symbol: str, order: Sequence[str], price: str, threshold: float = 0.10,
                 high: float = 0.20, max_group_rows: int | None = None) -> DataFrame:
    """One alert per row whose price moved at least ``threshold`` against the row before it."""
    prev = neighbour(df, [symbol], order, {"previous_price": price}, True, max_group_rows)
    change = F.try_divide(F.col(price) - F.col("previous_price"), F.col("previous_price"))
    size = F.abs(F.col("change_pct"))
    return (
        prev.withColumn("change_pct", change)
        .where(size >= threshold)
        .withColumn("severity", F.when(size >= high, "HIGH").otherwise("MEDIUM"))
        .withColumn("message", F.expr("concat('Price changed ', format_number(change_pct * 100, '0.00'), '%')"))
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Most recent row per key (``order`` ascending, last wins)."""
    return dedup_rows(df, keys, [F.col(c).desc() for c in order])


#: Marks of a group that one task adds up: each is wide (a decimal and its sum), and sorted and held by the window.
MARK_ROWS = 1_000_000


def moving_average(df: DataFrame, keys: Sequence[str], ts: str, value: Column, seconds: int, name: str,
                   max_group_rows: int | None = None) -> DataFrame:
    """Average of ``value`` over rows of the group with time in [t - seconds, t].

    A range frame adds up its whole frame again for every row. Here the work is linear: the sum
    up to ``t`` minus the sum before ``t - seconds``, over the distinct instants. Both come from
    one running total, in which each instant also appears as a row without value just before
    ``t - seconds``. ``value`` should be a decimal, so that the difference is exact.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    points = df.groupBy(*keys, micros.alias("_t")).agg(F.sum(value).alias("_v"), F.count(value).alias("_n"))
    zero = F.lit(0).cast(points.schema["_v"].dataType)
    # One scan gives both rows of an instant: its mark and the probe before its frame.
    mark = F.struct(F.col("_t").alias("_at"), F.lit(0).alias("_side"), F.coalesce("_v", zero).alias("_v"), F.col("_n"))
    probe = F.struct((F.col("_t") - seconds * 1_000_000 - 1).alias("_at"), F.lit(1).alias("_side"), zero.alias("_v"), F.lit(0).cast("bigint").alias("_n"))
    marks = points.select(*keys, "_t", F.inline(F.array(mark, probe)))
    sums = running_totals(marks, keys, ["_at", "_side", "_t"], {"_sv": F.col("_v"), "_sn": F.col("_n")}, max_group_rows or MARK_ROWS)

    def difference(c):
        return F.max(F.when(F.col("_side") == 0, F.col(c))) - F.max(F.when(F.col("_side") == 1, F.col(c)))

    avg = sums.groupBy(*keys, "_t").agg(F.try_divide(difference("_sv").cast("double"), difference("_sn")).alias(name))
    return _join_null_safe(df.withColumn("_t", micros), avg, [*keys, "_t"]).drop("_t")


def sessionize(df: DataFrame, keys: Sequence[str], ts: str, tie: str, gap_seconds: int, name: str = "session_no",
               max_group_rows: int | None = None) -> DataFrame:
    """Number the sessions of each key: a new one starts after more than ``gap_seconds`` of silence."""
    order = [ts, tie]
    late = F.col("_at") - F.col("_prev") > gap_seconds * 1_000_000
    starts = F.when(F.col("_prev").isNull() | late, 1).otherwise(0).cast("bigint")

    def plain(rows):
        w = _window(keys, order)
        flagged = rows.withColumn("_prev", F.lag("_at").over(w)).withColumn("_new", starts)
        return flagged.withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    def split(rows):
        w = _window(keys, order, True)
        before = with_carry(rows, keys, F.max("_at"), last_value)
        flagged = before.withColumn("_prev", F.coalesce(F.lag("_at").over(w), F.col("_carry"))).withColumn("_new", starts).drop("_carry")
        local = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
        counted = with_carry(flagged, keys, F.sum("_new"), sum_value)
        return counted.withColumn(name, local + F.coalesce("_carry", F.lit(0).cast("bigint"))).drop("_carry")

    timed = df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    return by_group_size(timed, keys, order, max_group_rows, None, plain, split).drop("_at", "_prev", "_new")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str],
                    max_group_rows: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group.

    The built-in ``percentile`` keeps every distinct value of a group in one task; for large
    groups the ranks are found from running counts of the distinct values instead.
    """
    data = df.where(F.col(value).isNotNull())

    def plain(rows):
        qs = F.percentile(F.col(value), F.array(*[F.lit(float(p)) for p in probs]))
        return rows.groupBy(*keys).agg(qs.alias("_q")).select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

    large = large_groups(data, keys, max_group_rows or MAX_QUANTILE_ROWS)
    if large is None:
        return plain(data)
    counts = large.rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    cum = running_total(counts, keys, [value], F.col("_n"), "_upto", max_group_rows)
    totals = large.rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    cum = _join_null_safe(cum, totals, keys) if keys else cum.withColumn("_all", F.lit(large.count))

    def at(index: Column) -> Column:
        inside = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
        return F.max(F.when(inside, F.col(value)))

    picks, out = [F.max("_all").alias("_all")], []
    for i, (p, n) in enumerate(zip(probs, names)):
        pos = F.lit(float(p)) * (F.col("_all") - 1)
        picks += [at(F.floor(pos)).alias(f"_lo{i}"), at(F.ceil(pos)).alias(f"_hi{i}")]
        out.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (pos - F.floor(pos))).alias(n))
    done = cum.groupBy(*keys).agg(*picks).select(*keys, *out)
    return done if large.rest is None else done.unionByName(plain(large.rest))
