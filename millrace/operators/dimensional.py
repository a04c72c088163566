"""Dimensions, facts and materialisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.upsert import upsert_replace
from millrace.sources.files import write_partitioned

NULL_MARK = "∅"


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """Hash key of several columns; NULL has its own mark, so (a, NULL) differs from (a)."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.sha2(F.concat_ws("|", *parts), 256)


def composite_key(cols: Sequence[str], sep: str = "-") -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def scd2_open(snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: datetime) -> DataFrame:
    """First version of every key."""
    start = F.lit(as_of).cast("timestamp_ntz")
    return snapshot.select(surrogate_key([*keys, start]).alias("version_key"), *keys, *tracked, start.alias("valid_from"),
                           F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))


def scd2(dim: DataFrame, snapshot: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: datetime) -> DataFrame:
    """Type 2 update: close changed rows, open their new version, add new keys, keep all history.

    Current rows and the snapshot (one row per key) meet in one full outer join; each meeting
    yields one or two output rows. Closed versions pass through untouched.
    """
    cols = ["version_key", *keys, *tracked, "valid_from", "valid_to", "is_current"]
    start = F.lit(as_of).cast("timestamp_ntz")
    now = dim.where("is_current").select(*[F.col(k).alias(f"_dk{i}") for i, k in enumerate(keys)], F.struct("version_key", *tracked, "valid_from").alias("_d"))
    new = snapshot.select(*[F.col(k).alias(f"_sk{i}") for i, k in enumerate(keys)], F.struct(*tracked).alias("_s"))
    meets = F.lit(True)
    for i in range(len(keys)):
        meets = meets & F.col(f"_dk{i}").eqNullSafe(F.col(f"_sk{i}"))
    both = now.join(new, meets, "full").select("_d", "_s", *[F.coalesce(f"_dk{i}", f"_sk{i}").alias(k) for i, k in enumerate(keys)])
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"_d.{c}").eqNullSafe(F.col(f"_s.{c}"))
    keep = F.col("_d").isNotNull() & (F.col("_s").isNull() | same)

    def version(key: Column, side: str, since: Column, until: Column, current: Column) -> Column:
        return F.struct(key.alias("version_key"), *[F.col(f"{side}.{c}").alias(c) for c in tracked],
                        since.alias("valid_from"), until.cast("timestamp_ntz").alias("valid_to"), current.alias("is_current"))

    old = version(F.col("_d.version_key"), "_d", F.col("_d.valid_from"), F.when(~keep, start), keep)
    fresh = version(surrogate_key([*keys, start]), "_s", start, F.lit(None), F.lit(True))
    versions = F.array_compact(F.array(F.when(F.col("_d").isNotNull(), old), F.when(~keep, fresh)))
    changed = both.select(*keys, F.explode(versions).alias("_v")).select(*keys, "_v.*").select(*cols)
    return dim.where("NOT is_current").select(*cols).unionByName(changed)


def scd1(dim: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Type 1 update: the snapshot's rows replace those of the dimension."""
    return upsert_replace(dim, snapshot, keys)


def dim_from_source(df: DataFrame, key: str, names: Mapping[str, str], name: str, unknown: str, constants: Mapping[str, object]) -> DataFrame:
    """Distinct keys with display names and constant attributes."""
    label = F
    for k, v in names.items():
        label = label.when(F.col(key) == k, v)
    return df.select(key).distinct().select(key, label.otherwise(unknown).alias(name), *[F.lit(v).alias(c) for c, v in constants.items()])


def materialise(df: DataFrame, name: str, mode: str, cluster_by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """``ephemeral`` returns the plan, ``view`` registers it, ``table`` saves it (bucketed if asked)."""
    spark = df.sparkSession
    if mode == "ephemeral":
        return df
    if mode == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if mode != "table":
        raise ValueError(f"unknown materialisation: {mode}")
    rows = df if buckets or not cluster_by else df.sortWithinPartitions(*cluster_by)
    writer = rows.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
    writer.saveAsTable(name)
    return spark.table(name)


def join_sections(spark: SparkSession, base: DataFrame, key: str, sections: Mapping[str, tuple[DataFrame | None, str]]) -> DataFrame:
    """Attach each source's section (a struct) to the base; an absent source gives NULL sections.

    Fails only if every source is absent. ``sections`` maps name to (table or None, DDL schema).
    """
    if all(df is None for df, _ in sections.values()):
        raise ValueError("all sources are missing")
    out = base
    for name, (df, ddl) in sections.items():
        schema = T.StructType.fromDDL(ddl)
        if df is None:
            out = out.withColumn(name, F.lit(None).cast(schema))
        else:
            packed = df.select(key, F.struct(*schema.fieldNames()).alias(name))
            out = out.join(packed, key, "left")
    return out


def hub(df: DataFrame, keys: Sequence[str], existing: DataFrame | None, loaded_at: datetime, source: str) -> DataFrame:
    """New business keys with their hash key."""
    rows = df.select(*keys).distinct().withColumns({
        "hub_key": surrogate_key(keys), "loaded_at": F.lit(loaded_at).cast("timestamp_ntz"), "record_source": F.lit(source)})
    return rows if existing is None else rows.join(existing.select("hub_key"), "hub_key", "left_anti")


def link(df: DataFrame, sides: Mapping[str, Sequence[str]], existing: DataFrame | None, loaded_at: datetime, source: str) -> DataFrame:
    """New relations between hubs; ``sides`` maps a hub key name to its business keys."""
    keys = [k for side in sides.values() for k in side]
    rows = df.select(*keys).distinct().select(
        surrogate_key(keys).alias("link_key"), *[surrogate_key(cols).alias(n) for n, cols in sides.items()],
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"), F.lit(source).alias("record_source"))
    return rows if existing is None else rows.join(existing.select("link_key"), "link_key", "left_anti")


def satellite(df: DataFrame, keys: Sequence[str], attributes: Sequence[str], current: DataFrame | None, loaded_at: datetime) -> DataFrame:
    """Attribute versions that differ from the current one, by hash difference."""
    rows = df.select(surrogate_key(keys).alias("hub_key"), *attributes, surrogate_key(attributes).alias("hash_diff"),
                     F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"))
    return rows if current is None else rows.join(current.select("hub_key", "hash_diff"), ["hub_key", "hash_diff"], "left_anti")


def write_star(fact: DataFrame, dims: Mapping[str, DataFrame], path: str, day: Sequence[str]) -> None:
    """Dimensions as plain tables, the fact partitioned by its day columns."""
    for name, dim in dims.items():
        dim.write.mode("overwrite").parquet(f"{path}/{name}")
    write_partitioned(fact, f"{path}/fact", day)


WIDER = {("int", "bigint"), ("float", "double"), ("int", "double"), ("smallint", "int"), ("tinyint", "int"),
          ("smallint", "bigint"), ("date", "timestamp"), ("int", "float")}


def schema_drift(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """Differences between two schemas with a verdict: additions, reorders and widenings are safe."""
    before, after = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    rows = []
    for name in dict.fromkeys([*before, *after]):
        a = before[name].dataType.simpleString() if name in before else None
        b = after[name].dataType.simpleString() if name in after else None
        if a is None:
            rows.append((name, "added", a, b, "safe"))
        elif b is None:
            rows.append((name, "dropped", a, b, "risky"))
        elif a != b:
            wide = (a, b) in WIDER
            rows.append((name, "widened" if wide else "changed", a, b, "safe" if wide else "risky"))
    shared_old = [n for n in before if n in after]
    if shared_old != [n for n in after if n in before]:
        rows.append(("*", "reordered", ",".join(before), ",".join(after), "safe"))
    return spark.createDataFrame(rows, "column string, change string, old_type string, new_type string, verdict string")
