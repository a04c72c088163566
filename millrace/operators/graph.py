"""PageRank on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def pagerank(edges: DataFrame, reset: float = 0.15, iterations: int = 10) -> DataFrame:
    """Ranks (sum 1) of the nodes of ``edges(src, dst)``.

    Parallel edges are counted once up front; nodes without outgoing edges spread their rank
    evenly. A round reads the ranks twice, so each round's ranks are written to the shared folder.
    """
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    out = pairs.groupBy("src").agg(F.sum("n").alias("total"))
    shares = stage(pairs.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")), "edges")
    sources, sinks = shares.select(F.col("src").alias("id"), F.lit(1).alias("has_out")), shares.select(F.col("dst").alias("id"), F.lit(0).alias("has_out"))
    nodes = stage(sources.unionByName(sinks).groupBy("id").agg(F.max("has_out").alias("has_out")), "nodes")
    count = nodes.count()
    ranks = nodes.withColumn("rank", F.lit(1.0 / count))
    for _ in range(iterations):
        passed = shares.join(ranks.select(F.col("id").alias("src"), "rank"), "src").select(
            F.col("dst").alias("id"), F.lit(0).alias("has_out"), (F.col("rank") * F.col("share")).alias("part"))
        received = passed.unionByName(nodes.withColumn("part", F.lit(0.0))).groupBy("id").agg(
            F.max("has_out").alias("has_out"), F.sum("part").alias("received"))
        lost = ranks.agg(F.coalesce(F.sum(F.when(F.col("has_out") == 0, F.col("rank"))), F.lit(0.0)).alias("lost")).scalar()
        rank = reset / count + (1 - reset) * (F.col("received") + lost / count)
        ranks = stage(received.select("id", "has_out", rank.alias("rank")), "ranks")
    return ranks.select("id", "rank")
