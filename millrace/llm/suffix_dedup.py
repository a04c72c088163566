"""Suffix-array dedup: remove every byte of a string of ``length`` bytes that also starts earlier.

Earlier: in a document of smaller id, or in the same one at a smaller offset. Strings never cross
documents, and they are judged on the input, not on what is left.

1. **Anchors.** In every window of ``length`` bytes the k-mer of the least hash (the leftmost of equal ones) is
   its anchor; equal windows have equal anchors at the same place. Counts of anchors over all texts,
   merged by ranges of the hash, leave those that occur at least twice, as sorted hash arrays.
2. **Segments.** The windows with the same occurrence of an anchor are one stretch of bytes, a segment. Segments of
   repeated anchors are shuffled by anchor. Of equal segments, in a task and again after the shuffle, only
   the earliest goes on; all windows of the others are repeats.
3. **Interval expansion.** The segments of a block of anchors are sorted to a Burrows-Wheeler transform. Intervals of
   its rows are extended backward, breadth first; an interval of depth d ends where the common prefix of two
   neighbours is d - 1, so common prefixes appear by increasing value, and the search stops at ``length``. Rows
   between two ends share a whole string: all but the earliest are repeats.
4. **Removal.** Repeats, as ranges per document, are stored like the anchors and looked up while the texts are read.

An anchor with more than ``HOT`` occurrences would make a block of its own without bound (a line in a third of all
texts, each time in other company). Its windows are compared one by one instead, by the hash of all ``length``
bytes - the intervals at which the expansion of step 3 would end - which combines before the shuffle.

Null and empty texts, and texts shorter than ``length``, lose nothing. Rows of equal id and equal text are one document
and get the same result (none is a repeat of the other); rows of equal id and different text are ordered by a hash of the text. A null id counts as
the smallest. Texts of any size are read in overlapping pieces of ``PIECE`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import tables
from millrace.llm.text import U64, buffers, giving_back, mix, prefix_hash, slices, substring_hash

LENGTH = 100
KMER = 32
HOT = 4096
NULL = -(1 << 63)
BLOCKS = "bucket long, block binary"
PIECE = 1 << 19
_PLACE = 20  # bits that hold a place in a piece


class Anchors(NamedTuple):
    hash: np.ndarray
    text: np.ndarray  # which of the texts
    first: np.ndarray  # first and last window start that has this anchor, in the data
    last: np.ndarray


def anchors(sums: np.ndarray, bounds: np.ndarray, length: int, kmer: int) -> Anchors:
    """Anchors of all windows within the texts data[bounds[i]:bounds[i + 1]], from the data's prefix hashes."""
    n = len(sums) - 1
    none = Anchors(*(np.zeros(0, t) for t in (U64, np.int64, np.int64, np.int64)))
    if n < length:
        return none
    h = substring_hash(sums, slice(0, n - kmer + 1), slice(kmer, n + 1), kmer)
    least = (h >> U64(_PLACE) << U64(_PLACE)) | np.arange(len(h), dtype=U64)
    width, span = length - kmer + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:len(least) - (width - span)], least[width - span:])
    place = (least & U64((1 << _PLACE) - 1)).astype(np.int64)  # anchor of the window that starts here
    windows = np.maximum(np.diff(bounds) - length + 1, 0)
    inside = np.zeros(len(place) + 1, np.int8)
    some = np.flatnonzero(windows)
    inside[bounds[:-1][some]] += 1
    inside[bounds[:-1][some] + windows[some]] -= 1
    start = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    if not len(start):
        return none
    place = place[start]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.append(first[1:], len(start)) - 1
    # least hashes are small numbers: mixed again, they are spread over all buckets
    return Anchors(mix(h[place[first]]), np.searchsorted(bounds, start[first], "right") - 1, start[first], start[last])


class Piece(NamedTuple):
    data: np.ndarray
    bounds: np.ndarray
    row: np.ndarray  # row of the batch of each text
    base: np.ndarray  # offset of each text's part in the text


def pieces(data: np.ndarray, bounds: np.ndarray, length: int, size: int = PIECE) -> Iterator[Piece]:
    """All windows of all texts, each in one piece."""
    for lo, hi in slices(bounds, size):
        a, b = int(bounds[lo]), int(bounds[hi])
        if b - a <= size:
            yield Piece(data[a:b], bounds[lo:hi + 1] - a, np.arange(lo, hi), np.zeros(hi - lo, np.int64))
            continue
        for at in range(a, b - length + 1, size - length + 1):
            end = min(at + size, b)
            yield Piece(data[at:end], np.array([0, end - at]), np.array([lo]), np.array([at - a]))


def first_of(key: np.ndarray, doc: np.ndarray, digest: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a row is the earliest of its key (one of equal ones), and whether it is later than that: rows of the
    same document and place are neither, they are the same string read twice."""
    order = np.lexsort((start, digest, doc, key))
    first, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    if len(key):
        new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        first[order[new]] = True
        least = order[new][np.cumsum(new) - 1]
        later[order] = (doc[order] != doc[least]) | (digest[order] != digest[least]) | (start[order] != start[least])
    return first, later


def document_key(doc: np.ndarray, digest: np.ndarray) -> np.ndarray:
    return mix(doc.view(U64) ^ mix(digest.view(U64)))


# ---- Burrows-Wheeler transform ----

def transform(symbols: np.ndarray, length: int) -> np.ndarray:
    """Suffixes in the order of their first ``length`` symbols at least (below 512; 0 after the end)."""
    n = len(symbols)
    key = np.zeros(n, np.int64)
    for i in range(7):
        key <<= 9
        key[:n - i] |= symbols[i:]
    depth = 7
    while True:
        order = np.argsort(key)
        own = key[order]
        rank = np.empty(n, np.int64)
        steps = np.concatenate([[0], np.cumsum(own[1:] != own[:-1])])
        rank[order] = steps
        if depth >= length or steps[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:n - depth] += rank[depth:] + 1
        depth *= 2


def prefix_ends(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Where a row's common prefix with the row before is shorter than ``length``.

    Exact for rows without the symbol 0 in their first ``length``: intervals are not extended by it.
    """
    n = len(symbols)
    before = symbols[order - 1]
    by_symbol = np.argsort(before, kind="stable")
    to = np.empty(n, np.int64)  # the row of the suffix that is one symbol longer
    to[by_symbol] = np.arange(n)
    first = symbols[order]
    ends = np.zeros(n + 1, bool)
    hi = np.append(np.flatnonzero(first[1:] != first[:-1]) + 1, n)
    lo = np.concatenate([[0], hi[:-1]])
    ends[0] = ends[hi] = True
    for _ in range(1, length):
        size = hi - lo
        total = np.cumsum(size)
        rows = np.arange(total[-1]) + np.repeat(lo - total + size, size)
        own = np.repeat(np.arange(len(lo)), size)
        keep = before[rows] != 0
        rows = to[rows[keep]]
        by_row = np.argsort(rows)
        rows, own = rows[by_row], own[keep][by_row]
        if not len(rows):
            break
        symbol = first[rows]
        cut = np.flatnonzero((rows[1:] != rows[:-1] + 1) | (own[1:] != own[:-1]) | (symbol[1:] != symbol[:-1]))
        lo, hi = rows[np.concatenate([[0], cut + 1])], rows[np.append(cut, len(rows) - 1)] + 1
        new = ~ends[hi]
        lo, hi = lo[new], hi[new]
        if not len(lo):
            break
        ends[hi] = True
    return ends[:n]


def repeated(segments: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, segment, offset) of the windows whose string occurs more than once in these segments."""
    sizes = np.array([len(s) for s in segments])
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    at = np.cumsum(sizes + 1) - sizes - 1
    symbols = data.astype(np.int16) + 1
    symbols[at + sizes] = 0
    order = transform(symbols, length)
    string = np.cumsum(prefix_ends(symbols, order, length))
    segment = np.repeat(np.arange(len(sizes)), sizes + 1)[order]
    offset = order - at[segment]
    whole = offset <= sizes[segment] - length
    string, segment, offset = string[whole], segment[whole], offset[whole]
    _, back, n = np.unique(string, return_inverse=True, return_counts=True)
    many = n[back] > 1
    return string[many], segment[many], offset[many]


# ---- Spark jobs ----

SEGMENT = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("digest", pa.int64()),
                     ("start", pa.int64()), ("end", pa.int64()), ("bytes", pa.binary())])
RANGES = "bucket long, key long, start long, end long"


def _blob(rows: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return out.getvalue().to_pybytes()


class Segments:
    """Segments of a task: equal ones are joined, the earliest goes on, the others' windows are repeats."""

    def __init__(self, bits: int, key_bits: int, limit: int = 8 << 20):
        self.edges, self.key_edges, self.limit = tables.edges(bits), tables.edges(key_bits), limit
        self.parts: list[list[np.ndarray]] = []
        self.bytes: list[bytes] = []
        self.held = 0

    def add(self, columns: list[np.ndarray], contents: list[bytes]) -> list[dict]:
        self.parts.append(columns)
        self.bytes += contents
        self.held += sum(map(len, contents)) + 64 * len(contents)
        return self.flush() if self.held > self.limit else []

    def flush(self) -> list[dict]:
        if not self.parts:
            return []
        anchor, content, doc, digest, start, end = (np.concatenate(x) for x in zip(*self.parts))
        keep, later = first_of(mix(anchor ^ mix(content)), doc, digest, start)
        rows = _range_rows(document_key(doc, digest)[later], start[later], end[later], self.key_edges)
        order = np.flatnonzero(keep)
        order = order[np.argsort(anchor[order], kind="stable")]
        cuts = [0, *np.searchsorted(anchor[order], self.edges), len(order)]
        for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if a < b:
                own = order[a:b]
                columns = [pa.array(x[own].view(np.int64)) for x in (anchor, content, doc, digest, start, end)]
                columns.append(pa.array([self.bytes[i] for i in own.tolist()], pa.binary()))
                rows.append({"bucket": bucket, "block": _blob(pa.RecordBatch.from_arrays(columns, schema=SEGMENT))})
        self.parts, self.bytes, self.held = [], [], 0
        return rows


def _merge_ranges(key: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of window starts in order, those that follow on each other joined (they don't overlap)."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], end[order]
    if not len(key):
        return key, start, end
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (start[1:] > end[:-1])])
    first = np.flatnonzero(new)
    return key[first], start[first], np.maximum.reduceat(end, first)


def _range_rows(key: np.ndarray, start: np.ndarray, end: np.ndarray, edges: np.ndarray) -> list[dict]:
    """Blocks of ranges; their buckets are below 0 to tell them from segments."""
    key, start, end = _merge_ranges(key, start, end)
    cuts = [0, *np.searchsorted(key, edges), len(key)]
    names = ["key", "start", "end"]
    return [{"bucket": -1 - i, "block": _blob(pa.RecordBatch.from_arrays([pa.array(x[a:b].view(np.int64)) for x in (key, start, end)], names=names))}
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]


def _batch(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("block", pa.binary())]))


def _tables(blocks) -> list:
    """Columns of all blocks, one after the other; bytes as (data, bounds)."""
    whole = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blocks])
    return [buffers(c) if c.type == pa.binary() else c.to_numpy() for c in whole.columns]


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", length: int = LENGTH, kmer: int = KMER, hot: int = HOT,
                 block_bytes: int = 1 << 17, folder: str | None = None) -> tuple[str, int]:
    """(folder, bits) of the table of repeated windows of the column ``text``, by ``document_key``."""
    frame = docs.select("text", F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL)).alias("doc"))
    folder = tables.new_folder(docs.sparkSession, "suffix", folder)
    bits = tables.bucket_bits(frame)

    def count_anchors(batches):
        held = tables.Counter(bits, 400_000)
        for batch in batches:
            for p in pieces(*buffers(batch.column(0)), length):
                yield from _batch(held.add(anchors(prefix_hash(p.data), p.bounds, length, kmer).hash))
        yield from _batch(held.flush())

    def store_anchors(pdf):
        keys, counts = tables.merge(pdf["block"])
        many = counts > 1
        tables.save(folder, "anchor", int(pdf["bucket"].iloc[0]), key=keys[many], count=counts[many])
        return pd.DataFrame({"n": [int(many.sum())]})

    frame.select("text").mapInArrow(giving_back(count_anchors), BLOCKS).groupBy("bucket").applyInPandas(store_anchors, "n long").agg(F.sum("n")).collect()

    def cut_segments(batches):
        held = Segments(bits + 4, bits)  # segments are the larger part: smaller buckets
        edges = tables.edges(bits)
        for batch in batches:
            data, bounds = buffers(batch.column(0))
            doc = batch.column(1).to_numpy()
            digests = np.array([xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], U64)
            for p in pieces(data, bounds, length):
                sums = prefix_hash(p.data)
                a = anchors(sums, p.bounds, length, kmer)
                keys, back = np.unique(a.hash, return_inverse=True)
                count = tables.lookup(folder, "anchor", bits, keys, {"count": (np.int64, 0)})["count"][back]
                some = np.flatnonzero(count > 1)
                a, count = Anchors(*(x[some] for x in a)), count[some]
                end = a.last + length
                content = substring_hash(sums, a.first, end)
                at = p.base - p.bounds[:-1]
                columns = [a.hash, content, doc[p.row][a.text], digests[p.row][a.text], a.first + at[a.text], a.last + 1 + at[a.text]]
                once, later = first_of(mix(a.hash ^ mix(content)), columns[2], columns[3], columns[4])
                rows = _range_rows(document_key(columns[2], columns[3])[later], columns[4][later], columns[5][later], edges)
                own, raw = once & (count <= hot), p.data.tobytes()
                rows += held.add([x[own] for x in columns], [raw[x:y] for x, y in zip(a.first[own].tolist(), end[own].tolist())])
                own = once & (count > hot)
                if own.any():  # window by window
                    cut = [x[own] for x in columns]
                    n = cut[5] - cut[4]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    begin, start = (np.repeat(x, n) + step for x in (a.first[own], cut[4]))
                    string = substring_hash(sums, begin, begin + length)
                    rows += held.add([string, string, np.repeat(cut[2], n), np.repeat(cut[3], n), start, start + 1], [b""] * len(start))
                yield from _batch(rows)
        yield from _batch(held.flush())

    def expand(pdf):
        bucket = int(pdf["bucket"].iloc[0])
        if bucket < 0:
            return pdf[["bucket", "block"]]
        anchor, content, doc, digest, start, end, text = _tables(pdf["block"])
        anchor, content = anchor.view(U64), content.view(U64)
        keep, later = first_of(mix(anchor ^ mix(content)), doc, digest.view(U64), start)
        again = [(document_key(doc, digest)[later], start[later], end[later])]
        data, bounds = text
        length_of = np.diff(bounds)
        order = np.flatnonzero(keep & (length_of > 0))  # hot windows come without bytes: their hash has said it all
        order = order[np.argsort(anchor[order], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], np.diff(anchor[order]) != 0])) if len(order) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(order)))
        block: list[int] = []
        held = 0
        for f, n in [*((f, n) for f, n in zip(first.tolist(), size.tolist()) if n > 1), (0, 0)]:
            own = order[f:f + n].tolist()
            if block and (not n or held >= block_bytes):
                again.append(_repeats(block, [data[bounds[i]:bounds[i + 1]].tobytes() for i in block], doc, digest, start, length))
                block, held = [], 0
            block += own
            held += int(length_of[own].sum())
        return pd.DataFrame(_range_rows(*(np.concatenate(x) for x in zip(*again)), tables.edges(bits)), columns=["bucket", "block"])

    def store_ranges(pdf):
        key, start, end = (x.copy() for x in _tables(pdf["block"]))
        key, start, end = _merge_ranges(key.view(U64), start, end)
        keys, begin, n = np.unique(key, return_index=True, return_counts=True)
        tables.save(folder, "repeat", -1 - int(pdf["bucket"].iloc[0]), key=keys, begin=begin, n=n, start=start, end=end)
        return pd.DataFrame({"n": [len(key)]})

    (
        frame.mapInArrow(giving_back(cut_segments), BLOCKS).groupBy("bucket").applyInPandas(expand, BLOCKS)
        .groupBy("bucket").applyInPandas(store_ranges, "n long").agg(F.sum("n")).collect()
    )
    return folder, bits


def _repeats(block: list[int], segments: list[bytes], doc, digest, start, length: int):
    rows = np.array(block)
    string, segment, offset = repeated(segments, length)
    row = rows[segment]
    at = start[row] + offset
    later = first_of(string, doc[row], digest.view(U64)[row], at)[1]
    return document_key(doc, digest)[row[later]], at[later], at[later] + 1


OUT = "n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept "


def dedup(docs: DataFrame, keep: Sequence[str] = ("doc_id",), doc_id: str = "doc_id", length: int = LENGTH, kmer: int = KMER,
          hot: int = HOT, as_text: bool = False, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: columns ``keep``, n_bytes and n_removed, spans (maximal removed runs, in bytes) and
    kept (the remaining bytes; ``as_text``: as a string, without characters of which only a part remains)."""
    folder, bits = find_repeats(docs, doc_id, length, kmer, hot, folder=folder)
    frame = docs.select("text", F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL)).alias("_doc"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[2:]
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batches):
        for batch in batches:
            data, bounds = buffers(batch.column(0))
            doc = batch.column(1).to_numpy()
            for lo, hi in slices(bounds, PIECE):
                texts = [data[bounds[i]:bounds[i + 1]].tobytes() for i in range(lo, hi)]
                own = document_key(doc[lo:hi], np.array([xxhash.xxh64_intdigest(x) for x in texts], U64))
                keys, back = np.unique(own, return_inverse=True)
                got = tables.lookup(folder, "repeat", bits, keys, {"begin": (np.int64, 0), "n": (np.int64, 0)})
                where = np.searchsorted(tables.edges(bits), keys, "right")
                spans: list[list[dict]] = []
                left: list[bytes] = []
                for text, k in zip(texts, back.tolist()):
                    found, rest, at = [], [], 0
                    if n := int(got["n"][k]):
                        begin, bucket = int(got["begin"][k]), int(where[k])
                        first, last = (tables.load(folder, "repeat", bucket, c)[begin:begin + n] for c in ("start", "end"))
                        last = last + length - 1
                        new = np.flatnonzero(np.concatenate([[True], first[1:] > last[:-1]]))
                        for a, b in zip(first[new].tolist(), last[np.append(new[1:], n) - 1].tolist()):
                            found.append({"start": a, "end": b})
                            rest.append(text[at:a])
                            at = b
                    rest.append(text[at:])
                    spans.append(found)
                    left.append(b"".join(rest))
                sizes = np.diff(bounds[lo:hi + 1])
                columns = [pa.array(sizes), pa.array(sizes - np.array([len(x) for x in left])), pa.array(spans, span), 
                           pa.array([x.decode("utf-8", "ignore") for x in left], pa.string()) if as_text else pa.array(left, pa.binary())]
                yield pa.RecordBatch.from_arrays([*(batch.column(i + 2).slice(lo, hi - lo) for i in range(len(kept))), *columns],
                                                 names=[*(f.name for f in kept), "n_bytes", "n_removed", "spans", "kept"])

    out = frame.mapInArrow(giving_back(remove), ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), OUT + ("string" if as_text else "binary")]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_removed", "spans", "kept")
