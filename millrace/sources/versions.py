"""Tables in versions (U11): a replace is one swap of a pointer, and a failed run leaves the old table.

Layout of a table::

    <path>/data/<id>/            Parquet files of one version, never changed once they are named
    <path>/log/00000000000000000007.json   manifest of version 7: its folder, schema, row count and high-water mark

The current version is the highest manifest. A writer writes its folder, then the manifest under a name of its own, and
renames that to the next number. The rename is the only step that readers see; it fails if another writer has that number. Stores
without an atomic rename (plain object stores) need a committer that gives one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.upsert import upsert_replace
from millrace.operators.windows import dedup_rows


class Manifest(NamedTuple):
    version: int
    folder: str
    schema: T.StructType
    rows: int
    mark: str | None  # high-water mark, as text


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one read the table."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        at = self._path(self.path)
        self._fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        # absolute, with its scheme: executors and other sessions read the same place
        self.path = self._fs.makeQualified(at).toString()

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _numbers(self, folder: str) -> list[str]:
        at = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        """Numbers of all committed versions that are kept."""
        return sorted(int(n[:-5]) for n in self._numbers("log") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        """Of the given or the current version; None if there is none."""
        known = self.versions()
        if not known or version is not None and version not in known:
            return None
        # a manifest is a few lines, read without a job
        name = f"{self.path}/log/{(known[-1] if version is None else version):020}.json"
        stream = self._fs.open(self._path(name))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        return Manifest(entry["version"], entry["folder"], T.StructType.fromJson(entry["schema"]), entry["rows"], entry["mark"])

    def read(self, version: int | None = None) -> DataFrame:
        entry = self.manifest(version)
        if entry is None:
            raise FileNotFoundError(f"{self.path}: no such version")
        return self.spark.read.schema(entry.schema).parquet(f"{self.path}/{entry.folder}")

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """The folder of a version to come; nobody reads it before ``commit``."""
        folder = f"data/{uuid.uuid4().hex}"
        writer = df.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/{folder}")
        return folder

    def commit(self, folder: str, after: int, mark: str | None = None) -> int:
        """Make a written folder the version that follows ``after``."""
        df = self.spark.read.parquet(f"{self.path}/{folder}")
        entry = {"version": after + 1, "folder": folder, "schema": json.loads(df.schema.json()), "rows": df.count(), "mark": mark}
        own = self._path(f"{self.path}/log/_{uuid.uuid4().hex}")
        out = self._fs.create(own, False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(own.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(own, self._path(f"{self.path}/log/{after + 1:020}.json"), none)
        except Exception as e:
            self._fs.delete(own, False)
            if after + 1 in self.versions():
                raise ConcurrentWrite(f"{self.path}: version {after + 1} exists") from e
            raise
        return after + 1

    def replace(self, df: DataFrame, mark: str | None = None, partition_by: Sequence[str] = ()) -> int:
        """Write ``df``, which may read this table, as the next version."""
        known = self.versions()
        return self.commit(self.write(df, partition_by), known[-1] if known else 0, mark)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete manifests but the last ``keep``, and data folders that none of those names; returns the folders.

        Folders that a running writer has not committed yet go too: call it when there is none.
        """
        kept = self.versions()[-keep:]
        folders = {self.manifest(v).folder for v in kept}
        for v in self.versions()[:-keep]:
            self._fs.delete(self._path(f"{self.path}/log/{v:020}.json"), False)
        gone = [f"data/{n}" for n in self._numbers("data") if f"data/{n}" not in folders]
        for folder in gone:
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)
        return gone


def incremental_model(table: VersionedTable, source: DataFrame, ts: str, keys: Sequence[str], order: Sequence[Column | str],
                      lookback: timedelta | None = None, full_refresh: bool = False) -> int | None:
    """Bring a table up to date with ``source``: the version made, None if there was nothing new.

    The first run and a full refresh take all rows. Others take those from the stored mark (the latest ``ts`` seen, less ``lookback``
    for late rows) on. Rows at the mark itself are taken again, since more of that instant may have come; by key they
    change nothing. ``order`` picks the row of a key that stays.
    """
    entry = None if full_refresh else table.manifest()
    latest = source.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("t")).first()["t"]
    if entry is None or entry.mark is None:
        known = table.versions()
        rows = dedup_rows(source, keys, order)
        return table.commit(table.write(rows), known[-1] if known else 0, latest and latest.isoformat())
    mark = datetime.fromisoformat(entry.mark)
    since = mark - lookback if lookback else mark
    fresh = source.where(F.col(ts).cast("timestamp_ntz") >= F.lit(since).cast("timestamp_ntz"))
    before = table.read(entry.version)
    merged = upsert_replace(before, dedup_rows(fresh, keys, order), keys).select(*before.columns)
    if fresh.exceptAll(before.select(*fresh.columns)).isEmpty():
        return None
    return table.commit(table.write(merged), entry.version, max(mark, latest or mark).isoformat())
