"""Synthetic sales (F15) and test streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The choices of the generated sales.
CATEGORIES = ("Electronics", "Clothing", "Home", "Books", "Sports")
REGIONS = ("North", "South", "East", "West")


def generate_sales(spark: SparkSession, rows: int, seed: int = 42, late_share: float = 0.1) -> DataFrame:
    """Sales with ids TXN000001.., amounts 10-1000, quantities 1-9, days of 2024 and some late events."""

    def pick(values, salt):
        index = (F.floor(F.rand(seed + salt) * len(values)) + 1).cast("int")
        return F.element_at(F.array(*[F.lit(v) for v in values]), index)

    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.rand(seed + 4) * 366).cast("int"))
    late = F.rand(seed + 5) < late_share
    delay = F.when(late, F.floor(120 + F.rand(seed + 6) * 361)).otherwise(0).cast("int")
    return spark.range(1, rows + 1).select(
        F.concat(F.lit("TXN"), F.when(F.col("id") < 1_000_000, F.lpad(F.col("id").cast("string"), 6, "0")).otherwise(F.col("id").cast("string"))).alias("transaction_id"),
        pick(CATEGORIES, 0).alias("category"), pick(REGIONS, 1).alias("region"),
        F.round(10 + F.rand(seed + 2) * 990, 2).alias("amount"), (F.floor(F.rand(seed + 3) * 9) + 1).cast("int").alias("quantity"),
        F.date_format(day, "yyyy-MM-dd").alias("date"), delay.alias("late_seconds"))


def json_file_stream(spark: SparkSession, path: str, schema: T.StructType | str, max_files: int = 1) -> DataFrame:
    """Micro-batch file source: at most ``max_files`` new files per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def rate_stream(spark: SparkSession, rows_per_second: int, buckets: int = 10, start_ms: int | None = None) -> DataFrame:
    """Test source with a derived ``value_bucket``; a start time gives replayable batches."""
    if start_ms is None:
        raw = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    else:
        raw = spark.readStream.format("rate-micro-batch").options(rowsPerBatch=rows_per_second, startTimestamp=start_ms).load()
    return raw.withColumn("value_bucket", (F.col("value") % buckets).cast("int"))
