"""Reshaping operators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One map entry per series; only the fields that are used are parsed.
OBSERVATIONS = "map<string,struct<observations:array<struct<date:string,value:string>>>>"


def flatten_fields(df: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Nested paths to typed flat columns: ``{new_name: (path, type)}``."""
    return df.select(*[F.col(path).cast(typ).alias(name) for name, (path, typ) in fields.items()])


def clean_name(name: str) -> str:
    """A valid column name: other characters become ``_``, a leading digit gets a ``_`` before it."""
    safe = re.sub(r"[^A-Za-z0-9_]", "_", name)
    return "_" + safe if safe[:1].isdigit() else safe


def _clean_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.StructType):
        names = [clean_name(f.name) for f in dt.fields]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise ValueError(f"field names collide after cleaning: {sorted(twice)}")
        return T.StructType([T.StructField(n, _clean_type(f.dataType), f.nullable) for n, f in zip(names, dt.fields)])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_clean_type(dt.elementType), dt.containsNull)
    if isinstance(dt, T.MapType):
        return T.MapType(_clean_type(dt.keyType), _clean_type(dt.valueType), dt.valueContainsNull)
    return dt


def sanitize_names(df: DataFrame) -> DataFrame:
    """Clean every field name, also inside structs, arrays and maps.

    A cast between struct types goes by position, so it renames without touching values.
    """
    target = _clean_type(df.schema)
    return df.select(*[
        F.col(f"`{old.name}`").cast(new.dataType).alias(new.name) for old, new in zip(df.schema.fields, target.fields)
    ])


def unpivot_values(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], name: str, value: str) -> DataFrame:
    """Wide to long, dropping NULL values; ``columns`` maps source column to its label."""
    labelled = df.select(*ids, *[F.col(c).alias(label) for c, label in columns.items()])
    return labelled.unpivot(list(ids), list(columns.values()), name, value).where(F.col(value).isNotNull())


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def explode_entries(df: DataFrame, map_col: str, key: str, value: str) -> DataFrame:
    """One row per map entry."""
    others = [c for c in df.columns if c != map_col]
    return df.select(*others, F.explode(map_col).alias(key, value))


def explode_observations(df: DataFrame, json_col: str, keep: Sequence[str] = (), series: Sequence[str] | None = None) -> DataFrame:
    """``{series: {observations: [{date, value}]}}`` to (series_id, date, value); unparseable values drop out."""
    parsed = df.select(*keep, F.explode(F.from_json(F.col(json_col), OBSERVATIONS)).alias("series_id", "_s"))
    if series is not None:
        parsed = parsed.where(F.col("series_id").isin(list(series)))
    rows = parsed.select(*keep, "series_id", F.explode("_s.observations").alias("_o"))
    return rows.select(*keep, "series_id", F.col("_o.date").alias("date"),
                       F.col("_o.value").try_cast("double").alias("value")).where("value IS NOT NULL")
