"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """CSV with a header and a fixed schema. PERMISSIVE keeps bad lines in ``_corrupt_record``."""
    if mode.upper() == "PERMISSIVE":
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(schema).options(header=True, mode=mode, columnNameOfCorruptRecord=CORRUPT).csv(path)


def read_csv_required(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """CSV as text columns; a missing file or required column raises before any row is read."""
    try:
        df = spark.read.options(header=True).csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(path) from None
        raise
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; fields outside the schema are ignored."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_text_lines(spark: SparkSession, path: str, contains: str | None = None) -> DataFrame:
    lines = spark.read.text(path)
    return lines if contains is None else lines.where(F.col("value").contains(contains))


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, NULL fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Overwrite the touched Parquet partitions only.

    The rebalance hint gathers each partition value in few files and lets adaptive execution
    split a value that holds a large share of the rows.
    """
    rows = df.hint("rebalance", *[F.col(c) for c in cols])
    if sort:
        rows = rows.sortWithinPartitions(*cols, *sort)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def compact(df: DataFrame, path: str, files: int | None = None) -> None:
    """Rewrite to ``files`` even files, or to files of the advisory size when not given."""
    rows = df.repartition(files) if files else df.hint("rebalance")
    rows.write.mode("overwrite").parquet(path)


def export(df: DataFrame, path: str, fmt: str) -> str:
    """Write as parquet, csv or json."""
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"Unknown destination: {fmt}")
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    return path


DISPOSITIONS = {"TRUNCATE": "overwrite", "APPEND": "append", "EMPTY": "errorifexists"}


def load_with_disposition(df: DataFrame, path: str, disposition: str, partition_by: Sequence[str] = ()) -> None:
    """Warehouse load modes: replace all, add, or only into an empty place."""
    writer = df.write.mode(DISPOSITIONS[disposition]).option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system for the folder alone; nothing below it is listed."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def new_file_paths(spark: SparkSession, source: str, ledger: str, glob: str = "*") -> DataFrame:
    """Landed files that the ledger does not list yet, with their sizes."""
    found = (spark.read.format("binaryFile").options(pathGlobFilter=glob, recursiveFileLookup=True).load(source)
             .select("path", "length", "modificationTime"))
    if not path_exists(spark, ledger):
        return found
    return found.join(spark.read.parquet(ledger).select("path"), "path", "left_anti")


def process_new_files(spark: SparkSession, source: str, schema: T.StructType, checkpoint: str,
                      write: Callable[[DataFrame, int], None], fmt: str = "csv", options: Mapping[str, object] | None = None) -> None:
    """Hand each landed file to ``write`` exactly once; a rerun sees only new files.

    The stream checkpoint is the ledger, so no list of files is kept in the driver.
    """
    stream = spark.readStream.schema(schema).options(**(options or {})).format(fmt).load(source)
    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def register_table(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Register a folder as a catalog table and find its partitions."""
    spark.catalog.createTable(name, path=path, source=fmt, schema=schema)
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def seed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A static table from literal rows."""
    return spark.createDataFrame(list(rows), schema)
