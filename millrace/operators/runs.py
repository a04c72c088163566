"""Ordered work over groups of any size.

A window such as ``lag(x) over (partition by symbol order by ts)`` sorts each group in one
task. That is fine for millions of small groups, but a group with a third of all rows would
sit in a single task. Operators here measure the largest group first (one narrow, map-side
combined count). Groups up to the limit keep the plain window. The rows of larger groups are
range-partitioned on (group, order) into balanced *runs*, the window works inside
(group, run), and one small summary per run is carried to the next run of the same group.

Because runs are contiguous in (group, order), at most one group crosses each run boundary,
so the carried table has fewer rows than there are runs: that is its size bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage

RUN = "_run"
MAX_GROUP_ROWS = 5_000_000
MAX_RUNS = 20_000


class Runs(NamedTuple):
    rows: DataFrame  # rows of the large groups with their run number
    rest: DataFrame | None  # rows of all other groups


def largest_group(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows of the largest group, all rows); only one row reaches the driver."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    row = sizes.agg(F.max("_n"), F.sum("_n")).first()
    return row[0] or 0, row[1] or 0


class Large(NamedTuple):
    rows: DataFrame  # rows of the groups over the limit
    rest: DataFrame | None  # all other rows
    count: int
    limit: int


def large_groups(df: DataFrame, keys: Sequence[str], max_group_rows: int | None = None,
                 sizes: tuple[int, int] | None = None) -> Large | None:
    """Part the groups over the limit from the others; None if no group is over it.

    ``sizes`` passes what ``largest_group`` found (or an upper bound of it), to spare the count.
    The limit grows with the table, so that there are never more than ``MAX_RUNS`` such groups.
    """
    biggest, total = sizes or largest_group(df, keys)
    limit = max(max_group_rows or MAX_GROUP_ROWS, math.ceil(total / MAX_RUNS))
    if biggest <= limit:
        return None
    if not keys:
        return Large(df, None, total, limit)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = stage(counts.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_n"), "hot")
    count = hot.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if not count:
        return None
    hot = F.broadcast(hot.drop("_n"))
    rows, rest = (df.join(hot, _same_keys(keys), how) for how in ("left_semi", "left_anti"))
    return Large(rows, rest, count, limit)


def split_runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_group_rows: int | None = None,
               sizes: tuple[int, int] | None = None) -> Runs | None:
    """Cut the large groups into runs of at most about the limit; None if there are none.

    ``order`` names ascending columns that, with the keys, identify a row: a total order is
    what lets the range partitioner cut anywhere.
    """
    large = large_groups(df, keys, max_group_rows, sizes)
    if large is None:
        return None
    cut = large.rows.repartitionByRange(2 * math.ceil(large.count / large.limit), *keys, *order)
    # The range bounds come from sampling, so the run numbers are written once and read by
    # every consumer instead of being computed again.
    return Runs(stage(cut.withColumn(RUN, F.spark_partition_id()), "runs"), large.rest)


def _same_keys(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return cond


def by_group_size(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_group_rows: int | None, sizes: tuple[int, int] | None,
                  plain: Callable[[DataFrame], DataFrame], split: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``split`` on the runs of the large groups and ``plain`` on all other rows."""
    runs = split_runs(df, keys, order, max_group_rows, sizes)
    if runs is None:
        return plain(df)
    done = split(runs.rows).drop(RUN)
    return done if runs.rest is None else done.unionByName(plain(runs.rest))


def _carried(rows: DataFrame, keys: Sequence[str], summary: Column, fold, forward: bool) -> DataFrame:
    """Per run that continues a group: ``fold`` over the summaries of the runs before (after) it."""
    per_run = rows.groupBy(*keys, RUN).agg(summary.alias("_s"))
    by = Window.partitionBy(*keys).orderBy(F.col(RUN).asc() if forward else F.col(RUN).desc())
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_run.withColumn("_carry", fold(F.col("_s"), earlier))
        .withColumn("_nth", F.row_number().over(by))
        .where("_nth > 1")
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(RUN).alias("_krun"), "_carry")
    )


def with_carry(rows: DataFrame, keys: Sequence[str], summary: Column, fold, forward: bool = True) -> DataFrame:
    """Rows plus ``_carry``: the folded summary of this group's earlier (later) runs, else NULL."""
    carried = _carried(rows, keys, summary, fold, forward)
    joined = rows.join(F.broadcast(carried), (F.col(RUN) == F.col("_krun")) & _same_keys(keys), "left")
    return joined.drop("_krun", *[f"_k{i}" for i in range(len(keys))])


def last_value(value: Column, earlier) -> Column:
    return F.last(value, ignorenulls=True).over(earlier)


def sum_value(value: Column, earlier) -> Column:
    return F.sum(value).over(earlier)
