"""Schema contracts in Avro schema form (F12), applied to whole tables."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "bytes": T.BinaryType(),
}


def _load(contract: str | Mapping) -> Mapping:
    return json.loads(contract) if isinstance(contract, str) else contract


def _branch(kind):
    """(type without null, whether null is allowed) of a field type."""
    if isinstance(kind, list):
        rest = [k for k in kind if k != "null"]
        if len(rest) != 1:
            raise ValueError(f"only unions of null and one type are supported: {kind}")
        return rest[0], True
    return kind, False


def _spark_type(kind, logical: str | None = None) -> T.DataType:
    if isinstance(kind, Mapping):
        name = kind["type"]
        if name == "record":
            return avsc_to_struct(kind)
        if name == "array":
            items, null = _branch(kind["items"])
            return T.ArrayType(_spark_type(items), null)
        if name == "map":
            values, null = _branch(kind["values"])
            return T.MapType(T.StringType(), _spark_type(values), null)
        if name == "enum":
            return T.StringType()
        return _spark_type(name, kind.get("logicalType"))
    if logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    if logical == "date":
        return T.DateType()
    return _SIMPLE[kind]


def avsc_to_struct(contract: str | Mapping) -> T.StructType:
    """The Spark schema of a record contract."""
    fields = []
    for f in _load(contract)["fields"]:
        kind, nullable = _branch(f["type"])
        fields.append(T.StructField(f["name"], _spark_type(kind, f.get("logicalType")), nullable))
    return T.StructType(fields)


def _relaxed(dt: T.DataType) -> T.DataType:
    """The type with NULLs allowed inside, so that a cast to it checks values only."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_relaxed(dt.elementType))
    if isinstance(dt, T.MapType):
        return T.MapType(dt.keyType, _relaxed(dt.valueType))
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _relaxed(f.dataType)) for f in dt.fields])
    return dt


def _converted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.TimestampType) and isinstance(have, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(value)
    return value.try_cast(_relaxed(want))


def enforce_contract(df: DataFrame, contract: str | Mapping) -> DataFrame:
    """The table in the contract's layout plus an ``errors`` array per row.

    Fields the table lacks take their default (a lacking field without one is an error for the
    whole table); unknown columns are dropped; values that do not fit become NULL with an error.
    """
    record = _load(contract)
    want = avsc_to_struct(record)
    have = {f.name: f.dataType for f in df.schema.fields}
    cols, errors = [], []
    for field, f in zip(want.fields, record["fields"]):
        kind, nullable = _branch(f["type"])
        if field.name not in have:
            if "default" not in f:
                raise ValueError(f"column {field.name} is missing and has no default")
            cols.append(F.lit(f["default"]).cast(field.dataType).alias(field.name))
            continue
        raw = F.col(field.name)
        value = _converted(raw, have[field.name], field.dataType)
        cols.append(value.alias(field.name))
        errors.append(F.when(raw.isNotNull() & value.isNull(), f"{field.name}: wrong type"))
        if isinstance(field.dataType, T.ArrayType) and not field.dataType.containsNull:
            errors.append(F.when(F.exists(value, lambda x: x.isNull()), f"{field.name}: empty element"))
        if not nullable:
            errors.append(F.when(raw.isNull(), f"{field.name}: required"))
        if isinstance(kind, Mapping) and kind.get("type") == "enum":
            errors.append(F.when(~raw.isin(*kind["symbols"]), f"{field.name}: not in enum"))
    found = F.array_compact(F.array(*errors).cast("array<string>")) if errors else F.array().cast("array<string>")
    return df.select(*cols, found.alias("errors"))
