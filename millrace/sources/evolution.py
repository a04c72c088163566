"""Schema changes of registered tables (F19, U16): a history per table, and a policy for what the catalog takes over."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dimensional import WIDER, schema_drift
from millrace.sources.files import path_exists, register_table

POLICIES = ("UPDATE", "LOG")
HISTORY = "table_name string, seen_at timestamp_ntz, column string, change string, old_type string, new_type string, verdict string, applied boolean"


def safe_schema(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old schema with the safe changes of the new one: wider types in place, added columns at the end.

    Dropped columns stay (they read as NULL from new files), and changes that may lose values are not taken over.
    """
    after = {f.name: f for f in new.fields}
    fields = []
    for f in old.fields:
        other = after.get(f.name)
        wider = other is not None and (f.dataType.simpleString(), other.dataType.simpleString()) in WIDER
        fields.append(T.StructField(f.name, other.dataType if wider else f.dataType))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new.fields if f.name not in old.fieldNames()])


def watch_schema(spark: SparkSession, name: str, path: str, history: str, policy: str, as_of: datetime, schema: T.StructType) -> DataFrame:
    """Compare a registered table with the newest files of its folder, and return the drift with what was applied.

    ``UPDATE`` takes safe changes over into the catalog, ``LOG`` only records. Every difference is appended to the ``history`` table; once
    table and files agree, another look adds nothing. ``schema`` is that of the newest files.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy: {policy}")
    known = T.StructType([T.StructField(f.name, f.dataType) for f in spark.table(name).schema.fields])
    drift = schema_drift(spark, known, schema)
    taken = F.lit(policy == "UPDATE") & (F.col("verdict") == "safe") & F.col("change").isin("added", "widened")
    entries = drift.select(F.lit(name).alias("table_name"), F.lit(as_of).cast("timestamp_ntz").alias("seen_at"), "*", taken.alias("applied"))
    if policy == "UPDATE" and spark.catalog.getTable(name).tableType != "EXTERNAL":
        raise ValueError(f"{name} is not an external table: its files would go with its entry")
    if policy == "UPDATE" and (target := safe_schema(known, schema)) != known:
        spark.sql(f"DROP TABLE {name}")  # external: its files stay
        register_table(spark, name, path, target)
    else:
        spark.catalog.refreshTable(name)  # new files are read, whatever their columns
    if not entries.isEmpty():
        entries.write.mode("append").parquet(history)
    return entries


def schema_history(spark: SparkSession, history: str, name: str) -> DataFrame:
    """All changes of a table that were seen; an empty table if there were none."""
    rows = spark.read.schema(HISTORY).parquet(history) if path_exists(spark, history) else spark.createDataFrame([], HISTORY)
    return rows.where(F.col("table_name") == name)
