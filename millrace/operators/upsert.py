"""Keyed writes on Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.windows import dedup_rows
from millrace.session import stage
from millrace.sources.files import path_exists, write_partitioned

MERGES: dict[str, Callable[[Column, Column], Column]] = {
    "new": lambda old, new: new,
    "old": lambda old, new: F.coalesce(old, new),
    "greatest": F.greatest,
    "least": F.least,
}


def _without(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the others don't have; NULL is a key value like any other."""
    theirs = others.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return rows.join(theirs, reduce(and_, same), "left_anti")


def upsert_replace(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """Insert or replace whole rows; ``order`` picks the winner among batch rows of one key.

    NULL is a key value like any other, so a batch written again changes nothing.
    """
    winners = dedup_rows(batch, keys, order) if order else batch
    return _without(target, winners, keys).unionByName(winners)


def upsert_merge(target: DataFrame, batch: DataFrame, keys: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Merge per column: ``new``, ``old``, ``greatest`` or ``least``; both sides hold one row per key (NULL is a key value)."""
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*[F.col(k).alias(f"_tk{i}") for i, k in enumerate(keys)], F.struct(*cols).alias("_t"))
    b = batch.select(*[F.col(k).alias(f"_bk{i}") for i, k in enumerate(keys)], F.struct(*cols).alias("_b"))
    same = [F.col(f"_tk{i}").eqNullSafe(F.col(f"_bk{i}")) for i in range(len(keys))]
    both = t.join(b, reduce(and_, same), "full").select("_t", "_b", *[F.coalesce(f"_tk{i}", f"_bk{i}").alias(k) for i, k in enumerate(keys)])

    def merged(c: str) -> Column:
        old, new = F.col(f"_t.{c}"), F.col(f"_b.{c}")
        together = MERGES[rules.get(c, "new")](old, new)
        return F.when(F.col("_b").isNull(), old).when(F.col("_t").isNull(), new).otherwise(together).alias(c)

    return both.select(*keys, *[merged(c) for c in cols]).select(*target.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The batch rows that are new: one per key, none whose key the target has."""
    return _without(dedup_rows(batch, keys, order), target, keys)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
                 rules: Mapping[str, str] | None = None, order: Sequence[Column | str] = ()) -> None:
    """Upsert a batch into a partitioned Parquet table.

    The batch is written to the shared scratch folder once. Only the partitions it touches are read: their
    values (as many as the batch has partitions) are a literal filter, which also prunes inside a micro-batch.
    The merged rows go to the scratch folder too, then replace those partitions; the same batch again gives the
    same table. Several batch rows of one key need ``order``, which picks the first; without it they are refused.
    A row must not move between partitions: the partition columns are part of or follow from the key. The table
    has one writer, and no reader while partitions are replaced.
    """
    batch = stage(dedup_rows(batch, keys, order) if order else batch, "batch")
    if not order and not batch.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"several rows of one key ({', '.join(keys)}) in a batch: give an order")
    if not path_exists(spark, path):
        write_partitioned(batch, path, partition_by)
        return
    touched = batch.select(*partition_by).distinct().collect()
    if not touched:
        return
    # one list per column prunes; the join keeps the exact combinations
    wanted = [F.col(c).isin(sorted({r[c] for r in touched if r[c] is not None})) | (F.col(c).isNull() if any(r[c] is None for r in touched) else F.lit(False))
              for c in partition_by]
    theirs = batch.select(*[F.col(c).alias(f"_part{i}") for i, c in enumerate(partition_by)]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_part{i}")) for i, c in enumerate(partition_by)]
    table = spark.read.schema(batch.schema).parquet(path).where(reduce(and_, wanted))
    current = table.join(theirs, reduce(and_, same), "left_semi").select(*batch.columns)
    merged = upsert_merge(current, batch, keys, rules) if rules else upsert_replace(current, batch, keys)
    write_partitioned(stage(merged, "upsert"), path, partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions the rows belong to; a rerun gives the same table."""
    write_partitioned(df, path, partition_by)


def newer_rows(source: DataFrame, target: DataFrame, ts: str, lookback: timedelta | None = None) -> DataFrame:
    """Source rows from the target's latest time on; ``lookback`` takes late rows in again.

    Rows at the latest time itself are taken: more of that instant may have come. Whoever adds them does so by key.

    The latest time is one value, read first so that the filter reaches the source scan.
    """
    latest = target.agg(F.max(ts)).first()[0]
    if latest is None:
        return source
    return source.where(F.col(ts) >= F.lit(latest - lookback if lookback else latest).cast(source.schema[ts].dataType))


def incremental_append(target: DataFrame, source: DataFrame, ts: str, keys: Sequence[str], order: Sequence[Column | str],
                       lookback: timedelta | None = None, full_refresh: bool = False) -> DataFrame:
    """The table after adding newer source rows by unique key."""
    if full_refresh:
        return dedup_rows(source, keys, order)
    return upsert_replace(target, newer_rows(source, target, ts, lookback), keys, order)
