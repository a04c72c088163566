"""Connected components of links in tables, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def _least_neighbour(edges: DataFrame, label: str) -> DataFrame:
    # Staged, so that the join below reads two plain tables and can split a node with very many links.
    return stage(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n"), label)


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to (node, root): the least node that each linked node reaches.

    Each round hangs a node's larger neighbours, then its smaller ones, below its least neighbour, until
    every node hangs directly below its root. Minima combine before the shuffle; every round is written
    to the shared folder. Links of a node to itself and nulls are left out.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        mark = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if mark == before or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both, "least")
        large = both.where("v > u").join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.least("m", "n").alias("v"))
        edges = stage(large.distinct(), "large")
        least = _least_neighbour(edges, "least")
        joined = edges.join(least, F.col("u") == F.col("n"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select(F.col("n"), F.col("m")))
        edges = stage(small.distinct(), "small")
