"""User functions (D01-D05). Each Python function has a native twin, which is the one to use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import quality


@F.udf(T.StringType(), useArrow=True)
def normalize_city_udf(city):
    return None if city is None else city.strip().title()


def normalize_city(city: Column) -> Column:
    return F.initcap(F.trim(city))


@F.pandas_udf(T.IntegerType())
def bucket_age_udf(age: pd.Series) -> pd.Series:
    return (age // 10) * 10


def bucket_age(age: Column) -> Column:
    return (F.floor(age / 10) * 10).cast("int")


CHECKS: dict[str, Callable[..., DataFrame]] = {}


def check(name: str):
    """Register a named check: a function (table, column, …) to the offending rows."""

    def register(fn):
        CHECKS[name] = fn
        return fn

    return register


@check("range")
def rows_outside(df: DataFrame, column: str, low: float = 0, high: float = 100) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


@check("not_null")
def rows_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def offending_rows(name: str, df: DataFrame, column: str, **args) -> DataFrame:
    return CHECKS[name](df, column, **args)


def model_from_config(config: Mapping[str, Mapping]) -> tuple[T.StructType, list[quality.Rule]]:
    """``{field: {type, required, min, max, choices}}`` to a schema and its rules."""
    fields, rules = [], []
    for name, spec in config.items():
        needed = spec.get("required", True)
        fields.append(T.StructField(name, T.StructType.fromDDL(f"x {spec['type']}")["x"].dataType, not needed))
        if needed:
            rules.append(quality.not_null(name))
        if "min" in spec or "max" in spec:
            rules.append(quality.in_range(name, spec.get("min"), spec.get("max")))
        if "choices" in spec:
            rules.append(quality.is_in(name, spec["choices"]))
    return T.StructType(fields), rules


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Custom code per partition over Arrow batches."""
    return df.mapInPandas(fn, schema)


def batch_zscores(column: str):
    """Partition function: adds the distance to the running mean of the partition so far."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, 0.0
        for pdf in batches:
            n += len(pdf)
            total += float(pdf[column].sum())
            yield pdf.assign(off_mean=pdf[column] - total / max(n, 1))

    return run


def batch_extremes(key: str, value: str):
    """Partition function: rows, least and greatest value per key and Arrow batch, to be combined by an aggregation."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.groupby(key, as_index=False, dropna=False).agg(rows=(key, "size"), least=(value, "min"), most=(value, "max"))

    return run
