"""Sketches that are stored per group and merged later: distinct counts (HLL) and quantiles (KLL).

A sketch is one binary column of bounded size, whatever the rows of its group. Tables of them are kept per
fine group (hour, day) and merged to coarser ones without reading the rows again. NULL and NaN are not counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 4,096 registers: a standard error of 1.6 %, at most about 4 KB a sketch.
LG_K = 12
#: KLL size: see ``rank_error``.
KLL_K = 400


def distinct_sketches(df: DataFrame, keys: Sequence[str | Column], value: str, name: str = "sketch", lg_k: int = LG_K) -> DataFrame:
    """One HLL sketch of ``value`` per group."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias(name))


def merge_distinct(sketches: DataFrame, keys: Sequence[str | Column], name: str = "sketch") -> DataFrame:
    """The sketches of finer groups as one per coarser group."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))


def distinct_error(lg_k: int = LG_K, deviations: float = 4.0) -> float:
    """Relative error that an estimate of a merged sketch stays within, at that many standard errors."""
    return deviations * 1.04 / math.sqrt(2 ** lg_k)


def quantile_sketches(df: DataFrame, keys: Sequence[str | Column], value: str, name: str = "sketch", k: int = KLL_K) -> DataFrame:
    """One KLL sketch of the doubles in ``value`` per group; a group without any number has an empty sketch."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(F.when(~F.isnan(number), number), k).alias(name))


def merge_quantiles(sketches: DataFrame, keys: Sequence[str | Column], name: str = "sketch") -> DataFrame:
    """The sketches of finer groups as one per coarser group."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(name).alias(name))


def quantile(sketch: str, prob: float) -> Column:
    """A value of about that rank; NULL for an empty sketch."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(prob))))


def rank_error(k: int = KLL_K) -> float:
    """Share of rows by which the rank of a quantile may be off (99 % of single estimates stay within a third of it)."""
    return 3 * 2.296 / k ** 0.9021


def sketched_iqr_bounds(sketches: DataFrame, sketch: str = "sketch", multiplier: float = 3.0) -> DataFrame:
    """Quartiles and outlier bounds from stored sketches, beside the exact ``iqr_bounds``."""
    q = sketches.withColumns({"q1": quantile(sketch, 0.25), "q3": quantile(sketch, 0.75)}).drop(sketch)
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"lower": F.col("q1") - multiplier * iqr, "upper": F.col("q3") + multiplier * iqr})


def true_ranks(df: DataFrame, keys: Sequence[str], value: str, marks: DataFrame, mark: str) -> DataFrame:
    """``marks`` (keys, ``mark``, more columns) with ``below`` and ``upto``: the exact shares of rows under and up to the mark.

    Rows meet the marks of their group and are counted at once, so nothing grows but the counts. NaN is not counted.
    """
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).groupBy(*keys, number.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    given = marks.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in marks.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rest = [c for c in given.columns if not c.startswith("_k")]
    part = {"below": F.when(F.col("_v") < F.col(mark), F.col("_n")), "upto": F.when(F.col("_v") <= F.col(mark), F.col("_n"))}
    return rows.join(given, same).groupBy(*keys, *rest).agg(
        *[(F.coalesce(F.sum(c), F.lit(0)) / F.sum("_n")).alias(n) for n, c in part.items()])
