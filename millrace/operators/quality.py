"""Data-quality rules and their runner (Q01-Q24).

``run_checks`` turns all row and metric rules of a table into one aggregation. Rules that
need their own grouping (uniqueness, outliers, references) add one small plan each. The
report has one row per rule: check, column, severity, passed, failed_rows, total_rows, detail.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.sums import exact_avg
from millrace.operators.aggregates import iqr_bounds
from millrace.operators.columns import attach_scalars
from millrace.operators.joins import orphans

REPORT = ("check", "column", "severity", "passed", "failed_rows", "total_rows", "detail")


class QualityError(ValueError):
    """Raised when a gate finds a failed rule of severity error."""


@dataclass(frozen=True)
class Rule:
    """One rule.

    ``failing`` marks bad rows; ``metric`` is an aggregate with a verdict on it; ``table``
    builds a one-row (failed_rows, total_rows, detail) frame; ``schema`` looks at the schema only.
    """

    check: str
    column: str
    needs: tuple[str, ...] = ()
    failing: Column | None = None
    detail: Callable[[], Column] | None = None
    metric: Column | None = None
    verdict: Callable[[Column], Column] | None = None
    table: Callable[[DataFrame], DataFrame] | None = None
    schema: Callable[[DataFrame], list[str]] | None = None
    severity: str = "error"

    def warn(self) -> "Rule":
        """The same rule, but a failure does not stop a run."""
        return replace(self, severity="warn")


def row_rule(check: str, column: str, ok: Column, needs: Sequence[str] | None = None, nulls_pass: bool = True) -> Rule:
    """Bad rows are those where ``ok`` is false (and, unless NULLs pass, unknown)."""
    failing = F.coalesce(~ok, F.lit(not nulls_pass))
    return Rule(check, column, tuple(needs if needs is not None else [column]), failing)


def not_null(column: str) -> Rule:
    return Rule("not_null", column, (column,), F.col(column).isNull())


def in_range(column: str, low=None, high=None, strict: bool = False) -> Rule:
    c = F.col(column)
    below = F.lit(False) if low is None else (c <= low if strict else c < low)
    above = F.lit(False) if high is None else (c >= high if strict else c > high)
    return Rule("in_range", column, (column,), F.coalesce(below | above, F.lit(False)),
                detail=lambda: F.format_string("below=%d above=%d", F.count_if(below), F.count_if(above)))


def matches(column: str, pattern: str) -> Rule:
    return row_rule("matches", column, F.col(column).rlike(pattern))


def starts_with(column: str, prefix: str) -> Rule:
    return row_rule("starts_with", column, F.col(column).startswith(prefix))


def min_length(column: str, n: int) -> Rule:
    return row_rule("min_length", column, F.length(column) >= n)


def is_in(column: str, allowed: Sequence) -> Rule:
    return row_rule("is_in", column, F.col(column).isin(*allowed))


def holds(check: str, columns: Sequence[str], ok: Column) -> Rule:
    """A rule across columns."""
    return row_rule(check, ",".join(columns), ok, columns)


def lowercase(column: str) -> Rule:
    return row_rule("lowercase", column, F.col(column) == F.lower(column))


def no_weekend(column: str) -> Rule:
    return row_rule("no_weekend", column, F.weekday(column) < 5)


def _metric(check: str, column: str, needs, value: Column, verdict: Callable[[Column], Column]) -> Rule:
    return Rule(check, column, tuple(needs), metric=value, verdict=verdict)


def mean_between(column: str, low: float, high: float, strict: bool = False) -> Rule:
    return _metric("mean_between", column, [column], exact_avg(column),
                   lambda m: (m > low) & (m < high) if strict else m.between(low, high))


def rows_between(low: int, high: int | None = None) -> Rule:
    return _metric("rows_between", "*", [], F.count(F.lit(1)),
                   lambda n: n >= low if high is None else n.between(low, high))


def max_null_ratio(column: str, ratio: float) -> Rule:
    """Share of NULLs at most ``ratio``; an empty table passes."""
    share = F.coalesce(F.try_divide(F.count_if(F.col(column).isNull()), F.count(F.lit(1))), F.lit(0.0))
    return _metric("max_null_ratio", column, [column], share, lambda s: s <= ratio)


def fresh(column: str, as_of: datetime, max_hours: float, mode: str = "newest") -> Rule:
    """Age of the newest (or oldest) row at ``as_of`` in hours; no row at all is stale."""
    edge = F.max(column) if mode == "newest" else F.min(column)
    now = F.lit(as_of).cast("timestamp_ntz").cast("timestamp")
    hours = (F.unix_micros(now) - F.unix_micros(edge.cast("timestamp"))) / 3_600_000_000
    return _metric(f"fresh_{mode}", column, [column], hours, lambda h: h <= max_hours)


def no_duplicates(columns: Sequence[str] | None = None, check: str = "no_duplicates") -> Rule:
    """Extra copies of rows (or of a key) beyond the first."""

    def run(df: DataFrame) -> DataFrame:
        keys = list(columns or df.columns)
        groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failed_rows"),
                          F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows")).withColumn("detail", F.lit(None).cast("string"))

    return Rule(check, ",".join(columns or ["*"]), tuple(columns or ()), table=run)


def unique(column: str | Column, name: str | None = None) -> Rule:
    """Rows minus distinct non-NULL values of a column or expression; NULLs count as duplicates."""
    value = F.col(column) if isinstance(column, str) else column

    def run(df: DataFrame) -> DataFrame:
        groups = df.groupBy(value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        return groups.agg((F.coalesce(F.sum("_n"), F.lit(0)) - F.count("_v")).alias("failed_rows"),
                          F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows")).withColumn("detail", F.lit(None).cast("string"))

    label = name or (column if isinstance(column, str) else "expression")
    return Rule("unique", label, (column,) if isinstance(column, str) else (), table=run)


def outliers(df: DataFrame, column: str, multiplier: float = 3.0) -> DataFrame:
    """Rows outside Q1 - m·IQR .. Q3 + m·IQR."""
    bounds = iqr_bounds(df, [], column, multiplier).select("lower", "upper")
    return attach_scalars(df, bounds).where(~F.col(column).between(F.col("lower"), F.col("upper"))).drop("lower", "upper")


def no_outliers(column: str, multiplier: float = 3.0) -> Rule:
    def run(df: DataFrame) -> DataFrame:
        bad = outliers(df, column, multiplier).agg(F.count(F.lit(1)).alias("failed_rows"))
        return attach_scalars(bad, df.agg(F.count(F.lit(1)).alias("total_rows"))).withColumn("detail", F.lit(None).cast("string"))

    return Rule("no_outliers", column, (column,), table=run)


def orphan_values(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(value, rows): every value of ``column`` that the parent lacks, with its number of rows; NULL is one of them."""
    lost = orphans(df.select(F.col(column).alias("value")), parent, "value", parent_key)
    return lost.groupBy("value").agg(F.count(F.lit(1)).alias("rows"))


def references(column: str, parent: DataFrame, parent_key: str) -> Rule:
    """Rows whose key is missing in the parent; up to ten of the missing values are named, all are in ``orphan_values``."""

    def run(df: DataFrame) -> DataFrame:
        lost = orphans(df.select(column), parent, column, parent_key).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        worst = lost.orderBy(F.col("_n").desc(), column).limit(10).agg(
            F.array_join(F.sort_array(F.collect_list(F.col(column).cast("string"))), ", ").alias("detail"))
        count = lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failed_rows"))
        return attach_scalars(attach_scalars(count, df.agg(F.count(F.lit(1)).alias("total_rows"))), worst)

    return Rule("references", column, (column,), table=run)


_FAMILIES = {
    "numeric": (T.NumericType,), "string": (T.StringType,),
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType), "boolean": (T.BooleanType,),
}


def types(expected: Mapping[str, str]) -> Rule:
    """Columns have the expected type: a family (numeric, string, datetime, boolean) or an exact Spark type."""

    def run(df: DataFrame) -> list[str]:
        found = {f.name: f.dataType for f in df.schema.fields}
        out = []
        for name, want in expected.items():
            if name not in found:
                out.append(f"{name} not found")
            elif want in _FAMILIES and not isinstance(found[name], _FAMILIES[want]):
                out.append(f"{name} should be {want}, is {found[name].simpleString()}")
            elif want not in _FAMILIES and found[name].simpleString() != want:
                out.append(f"{name} should be {want}, is {found[name].simpleString()}")
        return out

    return Rule("types", ",".join(expected), schema=run)


def columns_present(required: Sequence[str], strict: bool = False) -> Rule:
    """All required columns exist and, if strict, no others."""

    def run(df: DataFrame) -> list[str]:
        out = [f"{c} not found" for c in required if c not in df.columns]
        return out + ([f"{c} is not expected" for c in df.columns if c not in required] if strict else [])

    return Rule("strict_columns" if strict else "columns_present", ",".join(required), schema=run)


def _report_struct(rule: Rule, passed, failed, total, detail) -> Column:
    lit = lambda v, t: (v if isinstance(v, Column) else F.lit(v)).cast(t)
    return F.struct(F.lit(rule.check).alias("check"), F.lit(rule.column).alias("column"), F.lit(rule.severity).alias("severity"),
                    lit(passed, "boolean").alias("passed"), lit(failed, "bigint").alias("failed_rows"),
                    lit(total, "bigint").alias("total_rows"), lit(detail, "string").alias("detail"))


def run_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report of all rules as a DataFrame."""
    aggs, rows, tables = [F.count(F.lit(1)).alias("_total")], [], []
    for i, rule in enumerate(rules):
        absent = [c for c in rule.needs if c not in df.columns]
        if absent:
            rows.append(_report_struct(rule, False, None, F.col("_total"), f"column not found: {', '.join(absent)}"))
        elif rule.schema is not None:
            problems = rule.schema(df)
            rows.append(_report_struct(rule, not problems, None, F.col("_total"), "; ".join(problems) or None))
        elif rule.table is not None:
            one = rule.table(df)
            tables.append(one.select(F.inline(F.array(_report_struct(
                rule, F.col("failed_rows") == 0, F.col("failed_rows"), F.col("total_rows"), F.col("detail"))))))
        elif rule.metric is not None:
            aggs.append(rule.metric.alias(f"_m{i}"))
            value = F.col(f"_m{i}")
            rows.append(_report_struct(rule, F.coalesce(rule.verdict(value), F.lit(False)), None, F.col("_total"), value.cast("string")))
        else:
            aggs.append(F.count_if(rule.failing).alias(f"_f{i}"))
            if rule.detail is not None:
                aggs.append(rule.detail().alias(f"_d{i}"))
            rows.append(_report_struct(rule, F.col(f"_f{i}") == 0, F.col(f"_f{i}"), F.col("_total"),
                                       F.col(f"_d{i}") if rule.detail is not None else None))
    out = df.agg(*aggs).select(F.inline(F.array(*rows))) if rows else None
    for t in tables:
        out = t if out is None else out.unionByName(t)
    return out


def summary(report: DataFrame) -> DataFrame:
    """Total, passed, failed and warned rules, and whether the suite passed."""
    failed = ~F.col("passed") & (F.col("severity") == "error")
    return report.agg(F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks"),
                      F.count_if(failed).alias("failed_checks"), F.count_if(~F.col("passed") & (F.col("severity") == "warn")).alias("warnings"),
                      (F.count_if(failed) == 0).alias("suite_passed"))


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Return the table unchanged, or raise if a rule of severity error fails.

    The report that reaches the driver has one row per rule.
    """
    failed = run_checks(df, rules).where("NOT passed AND severity = 'error'").collect()
    if failed:
        raise QualityError("; ".join(
            f"{r['check']}({r['column']}): {r['failed_rows']} of {r['total_rows']} rows{' - ' + r['detail'] if r['detail'] else ''}" for r in failed))
    return df


def check_input(*rules: Rule):
    """Decorator: gate the first argument of a transform."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(df, *args, **kwargs):
            return fn(enforce(df, rules), *args, **kwargs)

        return run

    return wrap


def check_output(*rules: Rule):
    """Decorator: gate the result of a transform."""

    def wrap(fn):
        @functools.wraps(fn)
        def run(*args, **kwargs):
            return enforce(fn(*args, **kwargs), rules)

        return run

    return wrap


def _row_rules(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    return [r for r in rules if r.failing is not None and all(c in df.columns for c in r.needs)]


def failure_cases(df: DataFrame, rules: Sequence[Rule], ids: Sequence[str]) -> DataFrame:
    """All failing cells in long form: ids, column, check, failure_case."""
    cases = [F.when(r.failing, F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                                        (F.col(r.column) if r.column in df.columns else F.to_json(F.struct(*r.needs))).cast("string").alias("failure_case")))
             for r in _row_rules(df, rules)]
    return df.select(*ids, F.inline(F.array_compact(F.array(*cases))))


def with_errors(df: DataFrame, rules: Sequence[Rule], name: str = "errors") -> DataFrame:
    return df.withColumn(name, F.array_compact(F.array(*[
        F.when(r.failing, F.lit(f"{r.check}({r.column})")) for r in _row_rules(df, rules)]).cast("array<string>")))


def split_valid(df: DataFrame, errors: str = "errors", policy: str = "row") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) by an errors array; with policy ``batch`` one bad row rejects all."""
    bad = F.size(errors) > 0
    if policy == "row":
        return df.where(~bad).drop(errors), df.where(bad)
    if policy != "batch":
        raise ValueError(f"unknown policy: {policy}")
    any_bad = df.agg(F.coalesce(F.max(bad), F.lit(False)).alias("_any")).scalar()
    return df.where(~any_bad).drop(errors), df.where(any_bad)


def report_table(report: DataFrame, batch_id: str, checked_at: datetime) -> DataFrame:
    """Report rows as (batch_id, metric_name, metric_value, status, checked_at)."""
    status = F.when(F.col("passed"), "PASS").when(F.col("severity") == "warn", "WARN").otherwise("FAIL")
    return report.select(F.lit(batch_id).alias("batch_id"), F.concat_ws(":", "check", "column").alias("metric_name"),
                         F.coalesce(F.col("failed_rows"), (~F.col("passed")).cast("bigint")).cast("double").alias("metric_value"),
                         status.alias("status"), F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"))


def batch_metadata(df: DataFrame, batch_id: str, job: str, run_date: str, started: datetime, ended: datetime, status: str) -> DataFrame:
    """One row about a finished batch."""
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(batch_id).alias("batch_id"), F.lit(job).alias("dag_id"), F.lit(run_date).cast("date").alias("run_date"),
        F.lit(started).cast("timestamp_ntz").alias("start_time"), F.lit(ended).cast("timestamp_ntz").alias("end_time"),
        "record_count", F.lit(status).alias("status"))


def observed(df: DataFrame, step: str, rejected: Column | None = None) -> tuple[DataFrame, Observation]:
    """Count rows in and rejected while the job runs, without a second scan."""
    seen = Observation(step)
    bad = F.count_if(rejected) if rejected is not None else F.lit(0).cast("bigint") + F.count_if(F.lit(False))
    return df.observe(seen, F.count(F.lit(1)).alias("rows_in"), bad.alias("rejected")), seen


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose row counts differ between two tables, with both counts and which side lacks them."""
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    t = target.groupBy(*keys).agg(F.count(F.lit(1)).alias("target_rows"))
    both = s.unionByName(t, allowMissingColumns=True)
    both = both.groupBy(*keys).agg(F.coalesce(F.sum("source_rows"), F.lit(0)).alias("source_rows"),
                                     F.coalesce(F.sum("target_rows"), F.lit(0)).alias("target_rows"))
    side = (F.when(F.col("target_rows") == 0, "missing_in_target").when(F.col("source_rows") == 0, "extra_in_target")
            .otherwise("count_differs"))
    return both.where("source_rows <> target_rows").withColumn("finding", side)
