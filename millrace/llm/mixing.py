"""Mixing sources to target weights by Pareto order sampling.

* **Targets.** The sources, by code point with null last, have the weights 5, 2, 1, repeating, and share the
  words of all sources by weight. No target exceeds ``max_copies`` times the source's own words; the excess
  is shared again by weight until none is above. Only two sums per round reach the driver.
* **Whole copies.** With f = target / words of the source, every document is taken floor(f) times.
* **Fixed-size sample.** The rest of the target is filled with one more copy of some documents. A document's
  inclusion probability is the missing share times its preference over the source's mean preference.
  Documents are ranked by random odds u / (1 - u) divided by their inclusion odds, and taken in that order
  wherever they still fit in what is left of the target, to the last of them.

The random number of a document is a hash of its id and the seed, so reruns agree, as do rows of equal id.
A source may hold any share of the rows. The order is gone through in rounds: documents larger than what is left are set
aside (it only shrinks), ranks are cut into slices of about equal size, sums by (source, slice) tell in which slice
the first document lies that doesn't fit, and only the rows of that slice and the next ``FILL`` are ordered and tried one
by one. The next round goes on behind them, until no document is left that fits. The result doesn't depend on ``FILL``.

Null texts and texts without words have size 0 and take nothing; a source of such texts has target 0. A null
source is a source of its own. A null id is hashed as the empty text. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.ordering import numbered
from millrace.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
FILL = 200  # tried one by one in a round
SLICE_ROWS = 100_000
CAP = 1e-6  # inclusion probabilities stay this far from 0 and 1


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """``sizes`` (_source, _words, one row a source) plus _target."""
    ranked = stage(numbered(sizes, [F.col("_source").asc_nulls_last()], "_rank"), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    cap = (F.col("_words") * max_copies).cast("double")
    level, before = 0.0, None
    while level != before:  # the level only rises, and each round caps at least one more source
        before = level
        above = weight * F.lit(level) > cap
        total, capped, open_weight = ranked.agg(
            F.sum("_words"), F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(weight))
        ).first()
        if not total:
            break
        if open_weight:
            level = (total - capped) / open_weight
    return ranked.withColumn("_target", F.least(cap, weight * F.lit(level))).drop("_rank")


def mix(docs: DataFrame, keep: Sequence[str], source: str = "source", doc_id: str = "doc_id", size: Column | None = None,
        preference: Column | None = None, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = "mix",
        fill: int = FILL, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Columns ``keep`` and size, source_size, target (the source's), copies, taken (size times copies) of all rows.

    ``size``: words of a row; by default those of the column ``text``. ``preference``: a positive number, 1 by default.
    """
    size = n_words() if size is None else size
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))), 1, 13), 16, 10)
    u = (draw.cast("double") + 0.5) / float(1 << 52)
    rows = stage(
        docs.select(
            *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(source).alias("_source"), F.col(doc_id).alias("_id"),
            size.cast("long").alias("_size"), u.alias("_u"), (F.lit(1.0) if preference is None else preference.cast("double")).alias("_pref"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "mix",
    )
    sums = rows.groupBy("_source").agg(
        F.sum("_size").alias("_words"), F.count(F.lit(1)).alias("_rows"), F.sum(F.col("_size") * F.col("_pref")).alias("_wp"))
    factor = F.col("_target") / F.col("_words")
    sources = targets(sums, weights, max_copies).withColumns({
        "_whole": F.when(F.col("_words") > 0, F.floor(factor)).otherwise(F.lit(0)).cast("long"),
    }).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_words"))
    sources = stage(sources, "targets")
    most = sources.agg(F.max("_rows")).first()[0] or 0
    slices = max(256, math.ceil(most / slice_rows))

    # rank = random odds / inclusion odds; mapped to (0, 1), it is cut into slices
    chance = F.greatest(F.lit(CAP), F.least(F.lit(1 - CAP), F.col("_rest") / F.col("_words") * F.col("_pref") * F.col("_words") / F.col("_wp")))
    rank = F.col("_u") / (1 - F.col("_u")) * ((1 - chance) / chance)
    same = rows["_source"].eqNullSafe(sources["_source"])
    ranked = rows.join(sources, same).drop(sources["_source"]).withColumn("_rank", F.when(F.col("_size") > 0, rank))
    ranked = ranked.withColumn("_slice", F.floor(F.col("_rank") / (1 + F.col("_rank")) * slices).cast("long"))

    key = F.struct("_rank", "_id", "_size", "_row")
    waiting = stage(ranked.where("_size > 0").select("_source", "_rank", "_id", "_size", "_row", "_slice"), "waiting")
    state = sources.select(F.col("_source").alias("_ss"), F.col("_rest").cast("double").alias("_left"))
    state = state.withColumn("_after", F.lit(None).cast(waiting.select(key.alias("k")).schema["k"].dataType))
    rules, picks = [], []
    while True:
        state = stage(state, "left")
        here = F.col("_source").eqNullSafe(F.col("_ss"))
        waiting = stage(
            waiting.join(state, here).where(F.col("_size") <= F.col("_left")).where(F.col("_after").isNull() | (key > F.col("_after")))
            .select(*waiting.columns), "waiting")
        if waiting.isEmpty():
            break
        state, rule, pick = _round(waiting, state, key, fill)
        rules.append(rule)
        picks.append(pick)

    placed = ranked
    if rules:
        every = reduce(DataFrame.unionByName, rules).groupBy(F.col("_ss").alias("_rs")).agg(F.collect_list("_rule").alias("_rules"))
        picked = reduce(DataFrame.unionByName, picks).select(F.col("_row").alias("_pn"))
        placed = placed.join(stage(every, "rules"), F.col("_source").eqNullSafe(F.col("_rs")), "left").drop("_rs")
        placed = placed.join(stage(picked, "picked"), F.col("_row") == F.col("_pn"), "left")
        taken = F.exists("_rules", lambda r: (F.col("_size") <= r["left"]) & (r["after"].isNull() | (key > r["after"]))
                         & (r["cut"].isNull() | (F.col("_slice") < r["cut"]) | F.coalesce(key <= r["upto"], F.lit(False))))
        extra = F.when((F.col("_size") > 0) & (F.col("_pn").isNotNull() | F.coalesce(taken, F.lit(False))), 1).otherwise(0)
    else:
        extra = F.lit(0)
    copies = F.col("_whole") + extra
    return placed.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_size").alias("size"), F.col("_words").alias("source_size"),
        F.col("_target").alias("target"), copies.alias("copies"), (F.col("_size") * copies).alias("taken"))


def _round(waiting: DataFrame, state: DataFrame, key: Column, fill: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state after the round, rule by source, rows) of what a round takes of documents that each fit alone.

    A rule takes what fits before the cut; the rows are those taken one by one behind it, at most ``fill`` of a source.
    """
    per_slice = waiting.groupBy("_source", "_slice").agg(F.sum("_size").alias("_w"), F.count(F.lit(1)).alias("_n"))
    by, whole = Window.partitionBy("_source").orderBy("_slice"), Window.partitionBy("_source")
    cuts = (
        per_slice.join(state, F.col("_source").eqNullSafe(F.col("_ss")))
        .withColumns({"_cum": F.sum("_w").over(by), "_seen": F.sum("_n").over(by)})
        .withColumn("_cut", F.min(F.when(F.col("_cum") > F.col("_left"), F.col("_slice"))).over(whole))  # null: all fit
        .withColumn("_upto", F.max(F.when(F.col("_slice") == F.col("_cut"), F.col("_seen"))).over(whole) + fill)
        .groupBy(F.col("_source").alias("_cs"))
        .agg(F.first("_cut").alias("_cut"), F.max(F.when(F.col("_slice") < F.col("_cut"), F.col("_cum"))).alias("_before"),
             F.min(F.when(F.col("_seen") >= F.col("_upto"), F.col("_slice"))).alias("_last"),
             F.first("_left").alias("_left"), F.first("_after").alias("_after"))
    )
    cuts = stage(cuts, "cuts")

    near = waiting.join(cuts, F.col("_source").eqNullSafe(F.col("_cs"))) \
        .where((F.col("_slice") >= F.col("_cut")) & (F.col("_last").isNull() | (F.col("_slice") <= F.col("_last"))))
    by = Window.partitionBy("_source").orderBy("_rank", "_id", "_size", "_row")
    near = near.withColumns({
        "_fits": F.coalesce(F.col("_before"), F.lit(0)) + F.sum("_size").over(by.rowsBetween(Window.unboundedPreceding, 0)) <= F.col("_left"),
        "_n": F.row_number().over(by),
    }).withColumn("_nth", F.col("_n") - F.sum(F.col("_fits").cast("int")).over(Window.partitionBy("_source")))
    left = F.first("_left") - F.coalesce(F.first("_before"), F.lit(0)) - F.coalesce(F.sum(F.when(F.col("_fits"), F.col("_size"))), F.lit(0))
    tried = F.sort_array(F.collect_list(F.when((F.col("_nth") >= 1) & (F.col("_nth") <= fill), F.struct("_nth", "_size", "_row"))))
    behind = stage(
        near.groupBy(F.col("_source").alias("_ns")).agg(
            left.cast("double").alias("_l"), tried.alias("_tried"),  # at most ``fill`` entries
            F.max(F.when(F.col("_fits"), key)).alias("_upto"), F.max(F.when(F.col("_nth") <= fill, key)).alias("_at"))
        .select("_ns", "_upto", "_at",
                F.aggregate("_tried", F.struct(F.col("_l").alias("left"), F.array().cast("array<bigint>").alias("rows")), _take).alias("_a")),
        "behind")
    rule = cuts.join(behind, F.col("_cs").eqNullSafe(F.col("_ns")), "left").select(
        F.col("_cs").alias("_ss"),
        F.struct(F.col("_left").alias("left"), F.col("_after").alias("after"), F.col("_cut").alias("cut"), F.col("_upto").alias("upto")).alias("_rule"))
    after = behind.select(F.col("_ns").alias("_ss"), F.col("_a.left").alias("_left"), F.col("_at").alias("_after"))
    return after, rule, behind.select(F.explode("_a.rows").alias("_row"))


def _take(state: Column, row: Column) -> Column:
    fits = row["_size"] <= state["left"]
    return F.struct(
        F.when(fits, state["left"] - row["_size"]).otherwise(state["left"]).alias("left"),
        F.when(fits, F.concat(state["rows"], F.array(row["_row"]))).otherwise(state["rows"]).alias("rows"),
    )
