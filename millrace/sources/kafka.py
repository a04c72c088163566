"""Kafka and JDBC adapters (F09-F11). Thin on purpose: the logic behind them is plain DataFrame code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_offsets: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def parse_json_value(raw: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Broker rows (value bytes, timestamp) to typed columns plus ``kafka_timestamp``."""
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("_v"), F.col("timestamp").alias("kafka_timestamp"))
    return parsed.select("_v.*", "kafka_timestamp")


def read_kafka_json(spark: SparkSession, schema: T.StructType | str, servers: str, topic: str, starting: str = "earliest",
                    max_offsets: int | None = None) -> DataFrame:
    """Stream of JSON messages; needs the spark-sql-kafka package on the classpath."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_offsets)).load()
    return parse_json_value(raw, schema)


def read_kafka_avro(spark: SparkSession, avsc: str, servers: str, topic: str, starting: str = "earliest",
                    max_offsets: int | None = None) -> DataFrame:
    """Stream of Avro messages with the 5-byte registry header removed; needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_offsets)).load()
    body = F.expr("substring(value, 6, length(value) - 5)")
    return raw.select(from_avro(body, avsc, {"mode": "PERMISSIVE"}).alias("_v")).select("_v.*")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 1000,
               connections: int = 16, properties: dict[str, str] | None = None) -> None:
    """Append to or overwrite a SQL table with at most ``connections`` parallel writers.

    The rows are dealt to them by a shuffle, so that the stage before keeps all its tasks.
    """
    (df.repartition(connections).write.format("jdbc").mode(mode)
     .options(url=url, dbtable=table, batchsize=str(batchsize), **(properties or {})).save())
