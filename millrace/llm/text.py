"""Words of Arrow text columns as numpy arrays.

A word is a maximal run of bytes other than the ASCII white space 0x20 and 0x09-0x0D. All work is
on UTF-8 bytes of whole texts, in slabs of half a MB, so that a task's memory does not depend on
the size of its partition (one text is never cut; a slab holds at least one).
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import wraps
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLAB = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: 1: ASCII letters, 2: marks that no pre-tokenizer joins with a letter, 0: all else
KIND = np.zeros(256, np.uint8)
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[[ord(c) for c in '!"#$%&()*+,-./:;=?@[]^_`{}~\\']] = 2

_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=U64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted modulo 2^64
_SIZE = 0xD6E8FEB86659FD93
_POWERS = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def small_batches(spark) -> None:
    """Fewer rows in an Arrow batch than Spark's default, which fits short rows: texts may be long.

    The setting stays with the session, since it must hold when a DataFrame runs. An own setting is kept.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, "1000")


def giving_back(run):
    """A function over Arrow batches that, when it has ended, returns to the system what its worker no longer uses.

    Workers live on between tasks, and neither Arrow's pool nor the C allocator gives memory back by itself, so a job of many
    steps would hold the peak of each.
    """

    @wraps(run)
    def lean(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


class Slab(NamedTuple):
    data: np.ndarray  # bytes of the texts, one after the other
    bounds: np.ndarray  # where each text starts in data, and the end
    start: np.ndarray  # where each word starts in data
    end: np.ndarray
    words: np.ndarray  # index of each text's first word, and the number of words


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if binary else "")
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def slab(data: np.ndarray, bounds: np.ndarray, lower: bool = False, parts: bool = False) -> Slab:
    """``parts``: words also end between an ASCII letter and a mark (``KIND``)."""
    n = len(data)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    cuts = bounds[1:-1]
    before[cuts[cuts < n]] = False
    after[cuts[cuts > 0] - 1] = False
    if parts and n:
        kind = KIND[data]
        cut = (kind[1:] | kind[:-1]) == 3
        before[1:][cut] = False
        after[:-1][cut] = False
    start = np.flatnonzero(inside & ~before)
    return Slab(data, bounds, start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, bounds))


def slabs(column: pa.Array, lower: bool = False, limit: int = SLAB, parts: bool = False) -> Iterator[tuple[int, int, Slab]]:
    """(first row, end row, slab) over the column."""
    data, bounds = buffers(column)
    for lo, hi in slices(bounds, limit):
        own = bounds[lo:hi + 1]
        yield lo, hi, slab(data[own[0]:own[-1]], own - own[0], lower, parts)


def _powers(n: int, which: str) -> np.ndarray:
    if len(_POWERS[which]) < n:
        base = _BASE if which == "up" else pow(_BASE, -1, 2**64)
        factors = np.full(max(n, 2 * SLAB), base, U64)
        factors[0] = 1
        _POWERS[which] = np.cumprod(factors, dtype=U64)
    return _POWERS[which][:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any substring follows (``substring_hash``)."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * _powers(len(data), "up"), out=sums[1:])
    return sums


def substring_hash(sums: np.ndarray, start, end, length: int | None = None) -> np.ndarray:
    """64-bit hash of data[start:end]; equal bytes have equal hashes wherever they are.

    ``start`` and ``end`` are index arrays, or slices if all have the same ``length``.
    """
    poly = (sums[end] - sums[start]) * _powers(len(sums), "down")[start]
    if length is not None:
        return mix(poly + U64(length * _SIZE % 2**64))
    return mix(poly + (end - start).astype(U64) * U64(_SIZE))


def word_hash(s: Slab) -> np.ndarray:
    return substring_hash(prefix_hash(s.data), s.start, s.end)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BACK = [U64(pow(k, -1, 2**64)) for k in (0x94D049BB133111EB, 0xBF58476D1CE4E5B9)]


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    x = (x ^ (x >> U64(31)) ^ (x >> U64(62))) * _BACK[0]
    x = (x ^ (x >> U64(27)) ^ (x >> U64(54))) * _BACK[1]
    return x ^ (x >> U64(30)) ^ (x >> U64(60))


def total(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i + 1]] for each i."""
    sums = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def count_unique(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts (1 each if None)."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)
