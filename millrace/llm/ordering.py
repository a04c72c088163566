"""Places in a global order without bringing all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage


def numbered(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name``: 0, 1, 2, ... in the given order.

    Rows are range-partitioned and written once, each range is numbered on its own, and the counts of
    the ranges (one row per partition) give where each range starts.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = stage(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = sorted((r["_range"], r["count"]) for r in ranges.groupBy("_range").count().collect())
    first, starts = 0, []
    for part, count in counts:
        starts.append((part, first))
        first += count
    starts = spark.createDataFrame(starts, "_range int, _first long")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn(name, F.col("_first") + F.col("_place")).drop("_range", "_place", "_first")
