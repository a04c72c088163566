"""Token-ID output: files of ids under a canonical, length-limited Huffman code.

Layout of a file (all numbers little-endian), a sequence of sections, each holding whole texts:

* header, 6 x int64: ``MAGIC``, texts, ids, words of the bit stream, ids in a block, blocks
* the texts' keys (int64; null as the least int64) and numbers of ids (int64)
* bit offset of each block in the section's stream (int64): each block can be decoded on its own
* the bit stream as unsigned 32-bit words, the first bit the highest

``codes.npy`` beside the files has each id's code length, from which the canonical code follows (codes
ordered by length, then id). The lengths are the best ones of at most ``limit`` bits for the counts of
all ids (package-merge). ``index.json`` lists the files with the number of ids before each.

Texts are in ascending order of their key over all files; equal keys are ordered by a hash of their ids.
Null and empty texts are the end id alone. An empty table gives no file.
"""

from __future__ import annotations

import json
import os
import uuid
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import tables
from millrace.llm.tokens import encoded
from millrace.session import stage

MAGIC = 0x3153444946465548
LIMIT = 16
BLOCK = 1024
SECTION = 2_000_000
FILE_BYTES = 8 << 20
NULL = np.iinfo(np.int64).min


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best prefix code lengths of at most ``limit`` bits (0 where the count is 0)."""
    used = np.flatnonzero(counts)
    n = len(used)
    lengths = np.zeros(len(counts), np.uint8)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} different ids need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    row, is_leaf = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = row[:len(row) // 2 * 2].reshape(-1, 2).sum(1)
        row = np.concatenate([weights, packages])
        by_weight = np.argsort(row, kind="stable")
        row = row[by_weight]
        is_leaf.append(by_weight < n)
    taken = 2 * n - 2
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:taken].sum())
        lengths[order[:leaves]] += 1
        taken = 2 * (taken - leaves)
    return lengths


class Code(NamedTuple):
    lengths: np.ndarray  # bits of each id
    codes: np.ndarray  # code of each id
    symbol: np.ndarray  # id by the next ``limit`` bits
    limit: int

    @classmethod
    def of(cls, lengths: np.ndarray) -> Code:
        used = np.flatnonzero(lengths)
        order = used[np.argsort(lengths[used], kind="stable")]
        limit = int(lengths.max(initial=1))
        spans = np.int64(1) << (limit - lengths[order].astype(np.int64))
        begin = np.cumsum(spans) - spans
        codes = np.zeros(len(lengths), np.uint64)
        codes[order] = begin >> (limit - lengths[order].astype(np.int64))
        symbol = np.zeros(1 << limit, np.uint32)
        symbol[:spans.sum()] = np.repeat(order, spans)
        return cls(lengths, codes, symbol, limit)

    def encode(self, ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
        """(32-bit words of the bit stream, bit offset of each block)."""
        size = self.lengths[ids].astype(np.int64)
        end = np.cumsum(size)
        begin = end - size
        words = np.zeros((int(end[-1]) >> 5) + 3 if len(ids) else 3, np.uint64)
        if len(ids):
            place = self.codes[ids] << (64 - (begin & 31) - size).astype(np.uint64)
            at = begin >> 5
            first = np.flatnonzero(np.diff(at, prepend=-1))
            words[at[first]] += np.add.reduceat(place >> np.uint64(32), first)  # bits never overlap, so sums are unions
            words[at[first] + 1] += np.add.reduceat(place & np.uint64(0xFFFFFFFF), first)
        return words.astype("<u4"), begin[::block]

    def decode(self, words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
        """The ``n`` ids whose blocks start at ``offsets``; all blocks advance together, a table look-up each step."""
        wide = words.astype(np.uint64)
        wide = wide[:-1] << np.uint64(32) | wide[1:]
        sizes = self.lengths[self.symbol].astype(np.int64)
        out = np.empty((len(offsets), block), np.uint32)
        at, last = offsets.astype(np.int64), len(wide) - 1
        for step in range(min(block, n)):
            window = (wide[np.minimum(at >> 5, last)] >> (64 - self.limit - (at & 31)).astype(np.uint64)) & np.uint64((1 << self.limit) - 1)
            out[:, step] = self.symbol[window]
            at = at + sizes[window]
        return out.ravel()[:n] if block <= n else out[:, :n].ravel()[:n]


@lru_cache(maxsize=4)
def _code(folder: str) -> Code:
    return Code.of(np.load(f"{folder}/codes.npy"))


def _squeeze(ids: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _spread(block: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def write_files(docs: DataFrame, tokenizer: str, key: str = "doc_id", end: int = 2, folder: str | None = None,
                limit: int = LIMIT, block: int = BLOCK, section: int = SECTION) -> str:
    """Write the ids of the column ``text`` in the order of the integer column ``key``; the folder's path.

    ``tokenizer``: path of a vocabulary file that all nodes have. ``folder``: a path that all nodes mount; the
    default is in the shared folder. ``limit``: most bits of a code, at least log2 of the distinct ids.
    """
    spark = docs.sparkSession
    folder = tables.new_folder(spark, "token-ids", folder)
    frame = docs.select(F.col(key).cast("long").alias("key"), "text")
    files = max(1, tables.input_bytes(frame) // FILE_BYTES)

    def encode_texts(batches):
        for batch in batches:
            for lo, hi, ids, at in encoded(batch.column(1), tokenizer, end):
                blobs = [_squeeze(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(blobs, pa.binary())], names=["key", "ids"])

    def count_ids(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                own = np.bincount(_spread(blob), minlength=len(counts))
                own[:len(counts)] += counts
                counts = own
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(counts)), pa.array(counts[counts > 0])], names=["id", "n"])

    # Encoding costs most, so its result is written once; counts, order and files are read from it.
    coded = stage(frame.mapInArrow(encode_texts, "key long, ids binary"), "ids")
    counts = (
        coded.select("ids").mapInArrow(count_ids, "id long, n long")
        .groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # one row per vocabulary entry at most
    )
    by_id = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 0, np.int64)
    by_id[counts["id"]] = counts["n"]
    np.save(f"{folder}/codes.npy", code_lengths(by_id, limit))

    def write_file(batches):
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.ids"
        draft = f"{path}.{uuid.uuid4().hex}"
        texts = ids = size = 0
        keys: list[int] = []
        held: list[np.ndarray] = []
        with open(draft, "wb") as out:
            for batch in batches:
                for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    keys.append(NULL if k is None else k)
                    held.append(_spread(blob))
                    size += len(held[-1])
                    if size >= section:
                        _write_section(out, _code(folder), keys, held, block)
                        texts, ids = texts + len(keys), ids + size
                        keys, held, size = [], [], 0
            if keys:
                _write_section(out, _code(folder), keys, held, block)
                texts, ids = texts + len(keys), ids + size
        if not texts:
            os.remove(draft)
            return
        os.replace(draft, path)
        yield pa.RecordBatch.from_pylist([{"part": part, "texts": texts, "ids": ids}])

    order = [F.col("key").asc_nulls_first(), F.xxhash64("ids")]
    written = (
        coded.repartitionByRange(files, *order).sortWithinPartitions(*order)
        .mapInArrow(write_file, "part long, texts long, ids long").collect()  # one row per file
    )
    index, start = [], 0
    for r in sorted(written, key=lambda r: r["part"]):
        index.append({"file": f"part-{r['part']:06d}.ids", "start": start, "texts": r["texts"], "ids": r["ids"]})
        start += r["ids"]
    with open(f"{folder}/index.json", "w") as out:
        json.dump(index, out)
    return folder


def _write_section(out, code: Code, keys: list[int], held: list[np.ndarray], block: int) -> None:
    ids = np.concatenate(held)
    words, offsets = code.encode(ids, block)
    head = np.array([MAGIC, len(keys), len(ids), len(words), block, len(offsets)], "<i8")
    for part in (head, np.array(keys, "<i8"), np.array([len(x) for x in held], "<i8"), offsets.astype("<i8"), words):
        out.write(part.tobytes())


def read_sections(path: str, code: Code):
    """(keys, numbers of ids, ids) of each section of a file."""
    with open(path, "rb") as f:
        while head := f.read(48):
            magic, texts, n, words, block, blocks = np.frombuffer(head, "<i8").tolist()
            if magic != MAGIC:
                raise ValueError(f"{path} is damaged")
            keys, sizes, offsets = (np.frombuffer(f.read(8 * k), "<i8") for k in (texts, texts, blocks))
            yield keys, sizes, code.decode(np.frombuffer(f.read(4 * words), "<u4"), offsets, n, block)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per text: key, start (ids of all texts before it), n_tokens and ids (little-endian unsigned 32-bit)."""
    with open(f"{folder}/index.json") as f:
        index = json.load(f)
    schema = "key long, start long, n_tokens long, ids binary"
    if not index:
        return spark.createDataFrame([], schema)

    def read(batches):
        for batch in batches:
            for name, start in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                for keys, sizes, ids in read_sections(f"{folder}/{name}", _code(folder)):
                    at = np.concatenate([[0], np.cumsum(sizes)])
                    data = ids.astype("<u4").tobytes()
                    blobs = [data[4 * a:4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, mask=keys == NULL), pa.array(start + at[:-1]), pa.array(sizes), pa.array(blobs, pa.binary())],
                        names=["key", "start", "n_tokens", "ids"])
                    start += int(at[-1])

    files = spark.createDataFrame([(x["file"], x["start"]) for x in index], "file string, start long")
    return files.repartition(len(index)).mapInArrow(read, schema)
