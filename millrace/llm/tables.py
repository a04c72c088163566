"""Sorted hash arrays in the shared folder, and packed blocks for the shuffles that build them.

Counts travel as packed blocks (sorted keys as byte planes of their differences, and counts where
they are not 1), one row per task and bucket. The buckets are ranges of a 64-bit hash, so they are
even whatever the data, and a hot key is one entry per task. Each bucket is merged in one task,
which writes plain ``.npy`` arrays; a repeated task writes the same files again.

The arrays are memory-mapped by the workers, so the folder must be a path that all nodes mount
(``spark.checkpoint.dir`` as ``file:`` URI or path, or ``folder``). The pages are shared by the
workers of a node and belong to the file cache, not to the workers' memory.
"""

from __future__ import annotations

import math
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import U64, count_unique
from millrace.session import scratch_path

BUCKET_BYTES = 8 << 20
MIN_BUCKETS = 64
TRUSTED = 1 << 36


def mounted(path: str) -> str:
    """The plain path of a ``file:`` URI; other stores can't be memory-mapped."""
    plain = re.sub(r"^file:/+", "/", path)
    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", plain):
        raise ValueError(f"{path} can't be memory-mapped: give a folder that all nodes mount")
    return plain


def new_folder(spark: SparkSession, label: str, folder: str | None = None) -> str:
    path = mounted(f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}" if folder else scratch_path(spark, label))
    os.makedirs(path, exist_ok=True)
    return path


def input_bytes(df: DataFrame) -> int:
    """About how large the rows are; it only sets how many buckets there are.

    The optimizer's estimate serves where it is below ``TRUSTED``. Above, it may be a placeholder: rows that don't come
    from files count as 8 EB, joins as the product of their sides. There one scan adds up the bytes.
    """
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate < TRUSTED:
        return estimate
    texts = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    row = sum((F.coalesce(n.cast("long"), F.lit(0)) for n in texts), F.lit(8 * len(df.columns)).cast("long"))
    return df.agg(F.sum(row)).first()[0] or 0


def bucket_bits(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = MIN_BUCKETS) -> int:
    return max(math.ceil(math.log2(max(1, input_bytes(df) / bucket_bytes))), int(math.log2(least)))


def edges(bits: int) -> np.ndarray:
    """The least key of each bucket but the first."""
    return np.arange(1, 1 << bits, dtype=U64) << U64(64 - bits)


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys and their counts as one compressed block."""
    order = np.argsort(counts != 1, kind="stable")
    ones = int((counts == 1).sum())
    parts = [np.array([ones, len(keys)], np.int64).tobytes()]
    for part in (keys[order[:ones]], keys[order[ones:]]):
        parts.append(np.diff(part, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())
    parts.append(counts[order[ones:]].astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    ones, n = raw[:16].view(np.int64)
    many = n - ones

    def plane(at: int, size: int) -> np.ndarray:
        return np.ascontiguousarray(raw[at:at + 8 * size].reshape(8, -1).T).view(U64).ravel()

    a, b, c = plane(16, ones), plane(16 + 8 * ones, many), plane(16 + 8 * n, many)
    keys = np.concatenate([np.cumsum(a, dtype=U64), np.cumsum(b, dtype=U64)])
    return keys, np.concatenate([np.ones(ones, np.int64), c.astype(np.int64)])


class Counter:
    """Sums counts by key and hands them out as (bucket, block) rows.

    It holds at most about ``limit`` keys; what is beyond goes out early, to be added up later.
    """

    def __init__(self, bits: int, limit: int = 1_000_000):
        self.edges, self.limit = edges(bits), limit
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> list[dict]:
        keys, counts = count_unique(keys, counts)
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > 2 * self.limit:
            self._merge()
            if self.held > self.limit:
                return self.flush()
        return []

    def _merge(self) -> None:
        self.parts = [count_unique(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))]
        self.held = len(self.parts[0][0])

    def flush(self) -> list[dict]:
        if not self.parts:
            return []
        self._merge()
        keys, counts = self.parts[0]
        self.parts, self.held = [], 0
        cuts = [0, *np.searchsorted(keys, self.edges), len(keys)]
        return [{"bucket": i, "block": pack(keys[a:b], counts[a:b])} for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def merge(blocks: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in blocks]
    return count_unique(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def save(folder: str, name: str, bucket: int, **arrays: np.ndarray) -> None:
    """Write each array as a file of its own; the name appears only when it is whole."""
    for column, values in arrays.items():
        path = f"{folder}/{name}-{bucket}.{column}.npy"
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            np.save(out, np.ascontiguousarray(values))
        os.replace(part, path)


@lru_cache(maxsize=4096)
def load(folder: str, name: str, bucket: int, column: str) -> np.ndarray | None:
    """A memory-mapped array, None if this bucket has none. Call it only when the build has ended."""
    path = f"{folder}/{name}-{bucket}.{column}.npy"
    return np.load(path, mmap_mode="r") if os.path.exists(path) else None


def lookup(folder: str, name: str, bits: int, keys: np.ndarray, columns: dict[str, tuple]) -> dict[str, np.ndarray]:
    """Values of ascending ``keys``; ``columns`` gives (type, value where there is no such key, and the width
    of a row where it isn't one value) of each.

    The column ``at`` is the key's place in its bucket.
    """
    out = {c: np.full((len(keys), *width), missing, kind) for c, (kind, missing, *width) in columns.items()}
    cuts = [0, *np.searchsorted(keys, edges(bits)), len(keys)]
    for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if a == b or (stored := load(folder, name, bucket, "key")) is None or not len(stored):
            continue
        at = np.searchsorted(stored, keys[a:b])
        at[at == len(stored)] = 0
        hit = np.flatnonzero(stored[at] == keys[a:b])
        for c, values in out.items():
            if c == "at":
                values[a + hit] = at[hit]
            elif (column := load(folder, name, bucket, c)) is not None:  # a bucket without any such count has no file
                values[a + hit] = column[at[hit]]
    return out
