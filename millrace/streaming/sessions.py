"""Session windows on a stream with early results.

Spark's own session windows come out once, when the watermark has passed them. Here every batch shows the sessions as they are so far:
a late row may lengthen a session or join two, so a batch retracts the sessions that it changes and adds what they became.

Open sessions are a versioned table. A batch is first reduced to its own sessions, which are then laid beside the open ones in one pass over both:
a session that touches no other is as it was, or new; only those that touch are aggregated, and they are what the batch changes. A key has
few sessions, whatever its rows. Sums travel as limbs, so totals equal those of the whole table to the last bit; they are folded once per
session made, and the total stays beside its sums until the session changes. A session that
the watermark (latest time seen less ``delay``) has passed is closed: it is handed out for good and leaves the state. Rows that
are late by more are counted and left out.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.sums import LIMBS, fold, partial_sums
from millrace.session import stage
from millrace.sources.versions import VersionedTable

SUMS = [f"total_{i}" for i in range(LIMBS + 1)]


def _total() -> Column:
    return fold([F.col(c) for c in SUMS])


def _laid_out(pieces: DataFrame) -> DataFrame:
    """Sessions (key, start, last, actions, sums), with the number of their group (those of a key that touch) and of its members."""
    by = Window.partitionBy("key").orderBy("start", "last")
    reached = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(F.col("start") <= reached + F.col("gap"), 0).otherwise(1)  # as Spark's: a gap of just this length does not part
    numbered = pieces.withColumn("_new", apart).withColumn("_nth", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    # alone: this one opens a group, and so does the next of its key
    alone = (F.col("_new") == 1) & (F.coalesce(F.lead("_new").over(by), F.lit(1)) == 1)
    laid = numbered.withColumn("_alone", alone).drop("_new")
    return laid.withColumn("total", F.coalesce("total", F.when(F.col("_alone"), _total())))  # those that touch get theirs when joined


def _joined(pieces: DataFrame) -> DataFrame:
    """One session of each group."""
    return pieces.groupBy("key", "_nth").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("actions").alias("actions"),
                                             *[F.sum(c).alias(c) for c in SUMS], F.first("gap").alias("gap")).drop("_nth").withColumn("total", _total())


def shown(sessions: DataFrame, *also: str) -> DataFrame:
    """window_start, window_end, key, actions, total_value and the columns ``also``."""
    return sessions.select(F.col("start").alias("window_start"), (F.col("last") + F.col("gap")).alias("window_end"), "key", "actions",
                           F.col("total").alias("total_value"), *also)


class Sessions:
    """State and results of one stream of sessions, all under ``path``.

    ``changes`` has, per batch, the sessions retracted (op ``-``) and added (op ``+``); ``current`` the sessions as of now.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, ts: str, value: str, gap: timedelta = timedelta(minutes=30),
                 delay: timedelta = timedelta(minutes=10)):
        self.spark, self.key, self.ts, self.value, self.gap, self.delay = spark, key, ts, value, gap, delay
        self.open = VersionedTable(spark, f"{path}/open")
        self.path = self.open.path.removesuffix("/open")

    def _pieces(self, batch: DataFrame) -> DataFrame:
        gap = F.lit(self.gap)
        rows = batch.select(F.col(self.key).cast("string").alias("key"), F.col(self.ts).cast("timestamp_ntz").alias("at"), F.col(self.value).alias("value"))
        rows = rows.where("at IS NOT NULL").withColumn("t", F.col("at"))
        out = rows.groupBy(F.session_window("t", f"{int(self.gap.total_seconds())} seconds"), "key").agg(
            F.min("at").alias("start"), F.max("at").alias("last"), F.count(F.lit(1)).alias("actions"), *partial_sums("value", "total"),
            # one row's sum is its value; adding zero makes -0.0 a 0.0, as fold does
            F.when(F.count(F.lit(1)) == 1, F.max(F.col("value").cast("double")) + 0.0).alias("total"))
        return out.drop("session_window").withColumn("gap", gap)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Batch writer for ``start_query``; a replayed batch changes nothing."""
        entry = self.open.manifest()
        state = json.loads(entry.mark) if entry else {"batch": -1, "seen": None, "late": 0}
        if state["batch"] >= batch_id:
            return
        before = datetime.fromisoformat(state["seen"]) - self.delay if state["seen"] else None
        at = F.col(self.ts).cast("timestamp_ntz")
        late = F.lit(False) if before is None else at < F.lit(before)
        facts = batch.agg(F.max(at).alias("seen"), F.coalesce(F.count_if(late), F.lit(0)).alias("late")).first()
        pieces = self._pieces(batch.where(~late | at.isNull())).withColumn("_old", F.lit(False))
        seen = max([x for x in (facts["seen"], state["seen"] and datetime.fromisoformat(state["seen"])) if x], default=None)
        if entry:
            pieces = pieces.unionByName(self.open.read().withColumn("_old", F.lit(True)))
        laid = stage(_laid_out(pieces), "laid")
        same = ["key", "start", "last", "actions", *SUMS, "gap", "total"]
        joined = stage(_joined(laid.where("NOT _alone")).select(*same), "joined")
        moved = laid.where("_old <> _alone").select(*same, F.when(F.col("_old"), "-").otherwise("+").alias("op"))  # old ones that touch others, new ones that don't
        shown(moved.unionByName(joined.withColumn("op", F.lit("+"))), "op").write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        rest = laid.where("_alone").select(*same).unionByName(joined)
        done = F.lit(False) if seen is None else F.col("last") + F.col("gap") < F.lit(seen - self.delay)
        shown(rest.where(done)).write.mode("overwrite").parquet(f"{self.path}/closed/batch_id={batch_id}")
        mark = {"batch": batch_id, "seen": seen and seen.isoformat(), "late": state["late"] + facts["late"]}
        # the last step: before it, the same batch again writes the same folders
        self.open.commit(self.open.write(rest.where(~done)), entry.version if entry else 0, json.dumps(mark))
        self.open.vacuum(keep=2)

    def closed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/closed").drop("batch_id")

    def current(self) -> DataFrame:
        """Closed and open sessions."""
        return self.closed().unionByName(shown(self.open.read()))

    def changes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/changes")

    def late_rows(self) -> int:
        entry = self.open.manifest()
        return json.loads(entry.mark)["late"] if entry else 0

