"""Packing: hierarchical multi-length packing of token ids into training windows.

Per block of texts, within a task:

1. Whole windows of the longest size are cut off the front of each text.
2. The rest of a text goes to the tier of the least window that holds it (2048, 1024, 512, 256).
3. Windows are filled tier by tier, the longest first: each takes the longest waiting text, then fills
   its gap with the longest waiting ones of the shorter tiers that fit. When none fits, the front of
   the next longer waiting text is cut to close the gap.
4. What could not be closed stays in a window of the longest size, padded: one per block at most,
   and gaps of less than ``LEAST_CUT`` ids.
5. Windows of a block are dealt to step groups of ``step`` windows in the order of their attention
   cost (sum of squared lengths), forth and back, so that the groups cost about the same.

A window that is shorter than the longest size is always full, so padding only occurs in the longest
tier. The work is local to a task: nothing is shuffled, and a task holds one block (``BLOCK_IDS``
ids, or one text). Window numbers are the partition's number times 2^33 plus a count.

Null and empty texts are the end id alone. Rows with equal or null ids are packed like all others.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import giving_back
from millrace.llm.tokens import encoded

SIZES = (2048, 1024, 512, 256)
BLOCK_IDS = 2_000_000
LEAST_CUT = 16
STEP = 16


def plan(lengths: Sequence[int], sizes: Sequence[int] = SIZES) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (size, pieces), a piece being (text, start, length), in the order of their place."""
    longest = sizes[0]
    windows: list[tuple[int, list[tuple[int, int, int]]]] = []
    waiting: list[tuple[int, int, int]] = []  # (length, text, start), ascending
    for text, n in enumerate(lengths):
        whole = n // longest * longest
        windows.extend((longest, [(text, at, longest)]) for at in range(0, whole, longest))
        if n > whole:
            waiting.append((n - whole, text, whole))
    waiting.sort()
    while waiting:
        n, text, at = waiting.pop()
        size = min(s for s in sizes if s >= n)
        pieces, gap = [(text, at, n)], size - n
        while gap and waiting:
            i = bisect_right(waiting, (gap, len(lengths), 0)) - 1
            if i >= 0:
                n, text, at = waiting.pop(i)
                pieces.append((text, at, n))
                gap -= n
            elif size == longest and gap < LEAST_CUT:
                break
            else:
                n, text, at = waiting.pop(0)
                pieces.append((text, at, gap))
                insort(waiting, (n - gap, text, at + gap))
                gap = 0
        windows.append((size if not gap else longest, pieces))
    return windows


def step_groups(windows: list, step: int = STEP) -> list[int]:
    """The group of each window: groups of about ``step`` windows with about equal attention cost."""
    groups = -(-len(windows) // step)
    order = sorted(range(len(windows)), key=lambda i: -sum(n * n for _, _, n in windows[i][1]))
    out = [0] * len(windows)
    for k, i in enumerate(order):
        turn, place = divmod(k, groups)
        out[i] = place if turn % 2 == 0 else groups - 1 - place
    return out


OUT = {"row_start": "long", "length": "long", "doc_tokens": "long", "sequence_id": "long", "offset": "long",
       "window": "int", "step": "long", "ids": "binary"}


def pack(docs: DataFrame, tokenizer: str, keep: Sequence[str] = (), end: int = 1, sizes: Sequence[int] = SIZES,
         block_ids: int = BLOCK_IDS, step: int = STEP) -> DataFrame:
    """One row per piece of the column ``text``: columns ``keep``, start, length, doc_tokens, sequence_id, offset
    (place in the window), window (its size), step (its group) and ids (little-endian unsigned 32-bit).

    ``tokenizer``: path of a vocabulary file that all nodes have. ``sizes``: powers of two, descending.
    """
    if any(s & (s - 1) for s in sizes) or list(sizes) != sorted(set(sizes), reverse=True):
        raise ValueError("sizes must be descending powers of two")
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def pack_texts(batches):
        first = TaskContext.get().partitionId() << 33
        counts = {"windows": first, "groups": first}
        held: list[tuple[np.ndarray, np.ndarray, list[pa.Array]]] = []
        size = 0
        for batch in batches:
            for lo, hi, ids, at in encoded(batch.column(0), tokenizer, end):
                own = [batch.column(i + 1).slice(lo, hi - lo) for i in range(len(kept))]
                held.append((ids, at, own))
                size += len(ids)
                if size >= block_ids:
                    block, held, size = held, [], 0
                    yield _packed(block, kept, counts, sizes, step)
                    del block
        if held:
            yield _packed(held, kept, counts, sizes, step)

    types = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), *(f"{c} {t}" for c, t in OUT.items())])
    out = frame.mapInArrow(giving_back(pack_texts), types)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("row_start").alias("start"), *list(OUT)[1:])


def _cut(held: list, at: np.ndarray, n: np.ndarray) -> pa.Array:
    """The pieces of the held ids that start at ``at``, in one buffer, so that a block is copied once."""
    out, ends = np.empty(n.sum(), "<u4"), np.cumsum(n)
    first = np.cumsum([0, *(len(x) for x, _, _ in held)])
    of = np.searchsorted(first, at, "right") - 1  # a text lies within one part
    for part, a, k, end in zip(of.tolist(), (at - first[of]).tolist(), n.tolist(), ends.tolist()):
        out[end - k:end] = held[part][0][a:a + k]
    if out.nbytes >= 2**31:
        raise ValueError("a text of over 2 GB of ids does not fit an Arrow column")
    offsets = np.concatenate([[0], 4 * ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _packed(held: list, kept: list, counts: dict, sizes: Sequence[int], step: int) -> pa.RecordBatch:
    lengths = np.concatenate([np.diff(at) for _, at, _ in held])
    begin = np.cumsum(lengths) - lengths
    windows = plan(lengths.tolist(), sizes)
    groups = step_groups(windows, step)
    rows = []
    for i, (window, pieces) in enumerate(windows):
        offset = 0
        for text, start, n in pieces:
            rows.append((text, start, n, offset, i, window, groups[i]))
            offset += n
    text, start, n, offset, window, size, group = np.array(rows, np.int64).reshape(-1, 7).T
    own = [pa.concat_arrays([x[i] for _, _, x in held]).take(pa.array(text)) for i in range(len(kept))]
    columns = [pa.array(start), pa.array(n), pa.array(lengths[text]), pa.array(counts["windows"] + window), pa.array(offset),
               pa.array(size.astype(np.int32)), pa.array(counts["groups"] + group), _cut(held, begin[text] + start, n)]
    counts["windows"] += len(windows)
    counts["groups"] += max(groups, default=-1) + 1
    return pa.RecordBatch.from_arrays([*own, *columns], names=[*(f.name for f in kept), *OUT])
