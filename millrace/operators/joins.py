"""Joins beyond the plain equi join (J05-J16), safe for hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.runs import MAX_GROUP_ROWS, MAX_RUNS, largest_group
from millrace.operators.windows import _join_null_safe, locf
from millrace.session import stage

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether the table is proven to fit a broadcast: rows times the widest row seen."""
    width = F.max(F.length(F.to_json(F.struct(*df.columns)))).alias("w")
    n, w = df.limit(max_rows + 1).agg(F.count(F.lit(1)), width).first()
    return n <= max_rows and n * (w or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a size check; a larger table joins by shuffle."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Fact LEFT JOIN each dimension on ``{fact column: dimension column}``.

    Small dimensions are broadcast by Spark's own size statistics; others join by shuffle with
    adaptive skew splitting.
    """
    out = fact
    for dim, on in dims:
        cond = None
        for f, d in on.items():
            c = out[f] == dim[d]
            cond = c if cond is None else cond & c
        out = out.join(dim, cond, "left")
    return out


def _at(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    return F.col(col)


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: Sequence[str],
              values: Mapping[str, str], direction: str = "backward", max_group_rows: int | None = None) -> DataFrame:
    """For each left row the right row of the same series nearest before it (at or before).

    ``direction="forward"`` takes the nearest at or after. ``values`` maps right columns to
    result names. ``right`` holds one row per (series, time). The distinct left instants and
    the right rows are stacked and the last value is carried forward; there is no range join,
    and a series of any size is split into balanced runs.
    """
    sign = 1 if direction == "backward" else -1
    picked = F.struct(*[F.col(src).alias(dst) for src, dst in values.items()])
    marks = right.select(*by, (sign * _at(right, right_on)).alias("_at"), F.lit(0).alias("_side"), picked.alias("_val"))
    for k in by:  # a NULL series has no values, so NULL never matches NULL
        marks = marks.where(F.col(k).isNotNull())
    at = sign * _at(left, left_on)
    probes = left.select(*by, at.alias("_at")).distinct()
    probes = probes.select(*by, "_at", F.lit(1).alias("_side"), F.lit(None).cast(marks.schema["_val"].dataType).alias("_val"))
    # Rows before the distinct bound the group sizes without running the distinct twice.
    sizes = largest_group(left.select(*by, F.lit(1).alias("_one")).unionByName(right.select(*by, F.lit(1).alias("_one"))), by)
    filled = locf(marks.unionByName(probes), by, ["_at", "_side"], "_val", "_found", max_group_rows, sizes)
    found = filled.where("_side = 1").select(*by, "_at", "_found")
    joined = _join_null_safe(left.withColumn("_at", at), found, [*by, "_at"]).drop("_at")
    return joined.select("*", *[F.col(f"_found.{n}").alias(n) for n in values.values()]).drop("_found")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, null_is_orphan: bool = True) -> DataFrame:
    """Child rows whose key is not in the parent; NULL keys count as orphans unless told otherwise."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    out = child.join(keys, child[child_key] == F.col("_pk"), "left_anti")
    return out if null_is_orphan else out.where(F.col(child_key).isNotNull())


def hot_keys(df: DataFrame, key: str, max_key_rows: int | None = None) -> DataFrame:
    """Keys with more rows than the limit and how many pieces each needs.

    The limit grows with the table, so that there are never more than ``MAX_RUNS`` such keys.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(max_key_rows or MAX_GROUP_ROWS, -(-total // MAX_RUNS))
    return counts.where(F.col("_n") > limit).select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / limit).cast("int").alias("_pieces"))


def salted_join(big: DataFrame, small: DataFrame, key: str, row_id: Sequence[str], how: str = "inner",
                max_key_rows: int | None = None) -> DataFrame:
    """Equi join that spreads each hot key of ``big`` over several tasks.

    Only hot keys get salts: their ``big`` rows take one by the hash of ``row_id`` and their
    ``small`` rows are repeated once per salt, so each pair still meets exactly once.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join repeats the right side: inner or left only")
    hot = stage(hot_keys(big, key, max_key_rows), "hot")
    if hot.isEmpty():
        return big.join(small, key, how)
    hot = F.broadcast(hot)
    pieces = F.coalesce("_pieces", F.lit(1))
    left = big.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*row_id), pieces).cast("int")).drop("_hot", "_pieces")
    right = small.join(hot, F.col(key) == F.col("_hot"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_hot", "_pieces")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def split_skew_join(big: DataFrame, small: DataFrame, key: str, row_id: Sequence[str],
                    max_key_rows: int | None = None) -> DataFrame:
    """Inner join: hot keys by broadcast of their few right rows, all others by shuffle.

    If the right rows of the hot keys are themselves too many to broadcast, the salted join
    takes over. NULL keys never match.
    """
    hot = stage(hot_keys(big, key, max_key_rows).select(F.col("_hot").alias(key)), "hot")
    if hot.isEmpty():
        return big.join(small, key)
    hot = F.broadcast(hot)
    small_hot = small.join(hot, key, "left_semi")
    if not is_small(small_hot):
        return salted_join(big, small, key, row_id, "inner", max_key_rows)
    rest = big.join(hot, key, "left_anti").join(small.join(hot, key, "left_anti"), key)
    return big.join(hot, key, "left_semi").join(F.broadcast(small_hot), key).unionByName(rest)


def map_lookup(value: Column, mapping: Mapping) -> Column:
    """Look a value up in a fixed small mapping; unknown values give NULL."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), value)


def coalesce_sources(primary: DataFrame, secondary: DataFrame, keys: Sequence[str],
                     tags: tuple[str, str] = ("primary", "secondary")) -> DataFrame:
    """The primary source's row for each key, else the fallback's, tagged with ``_source``.

    Both sides hold one row per key.
    """
    rest = [c for c in primary.columns if c not in keys]
    p = primary.select(*keys, F.struct(*rest).alias("_p"))
    s = secondary.select(*keys, F.struct(*rest).alias("_s"))
    both = p.join(s, list(keys), "full")
    row = F.coalesce("_p", "_s")
    return both.select(*keys, *[row[c].alias(c) for c in rest],
                       F.when(F.col("_p").isNotNull(), tags[0]).otherwise(tags[1]).alias("_source"))


def await_match(orders: DataFrame, payments: DataFrame, key: Sequence[str], order_time: str, payment_time: str,
                payment_id: str, wait_seconds: int, max_group_rows: int | None = None) -> DataFrame:
    """Batch twin of the order/payment matcher: the first payment of the key at or after the
    order, if it comes within the wait; otherwise the order failed."""
    first = payments.groupBy(*key, payment_time).agg(F.min(payment_id).alias(payment_id))
    found = asof_join(orders, first, order_time, payment_time, key,
                      {payment_id: "_pid", payment_time: "_ptime"}, "forward", max_group_rows)
    wait = F.unix_micros(F.col("_ptime").cast("timestamp")) - F.unix_micros(F.col(order_time).cast("timestamp"))
    paid = wait <= wait_seconds * 1_000_000
    return found.withColumns({
        payment_id: F.when(paid, F.col("_pid")),
        "status": F.when(paid, "completed").otherwise("failed"),
    }).drop("_pid", "_ptime")
