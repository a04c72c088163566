"""SimHash near-duplicates by multi-index hashing.

* **Fingerprint.** Words of the lower-cased (A-Z) text, shingles of ``width`` words joined by one space, repeats
  included; fewer words make one shingle, none the fingerprint 0. A bit is set if it is set in over half
  of the shingles' XXH64 hashes (seed 42).
* **Index.** The 64 bits are cut into ``segments``. Two fingerprints that differ in at most ``distance`` bits differ
  in at most t bits in some segment, for radii t whose (t + 1) add up to more than the distance. So each
  fingerprint is entered under every value in the ball of that radius about its segment, and those that
  meet under a value are compared in full.
* **Links.** Equal fingerprints are one node. Under one value, links are found by a search that takes every
  fingerprint once, and only links of a forest leave the task: their number is linear in the fingerprints,
  however many of them are alike. Values with very many fingerprints are indexed again within the task by the
  other bits. Nothing is capped or dropped.

Null and empty texts have fingerprint 0 and are linked like any other. Rows of equal id are rows of their own.
The component is named by the least id in it (nulls last: null only if all are null).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.text import SPACE, U64, slabs
from millrace.session import stage

WIDTH = 4
DISTANCE = 4
SEGMENTS = 3
SEED = 42
PAIRS_UP_TO = 12  # runs of so many are compared pair by pair
AGAIN_FROM = 20_000  # runs from so many are indexed again


def majority(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of hashes: the bits that over half of its hashes have; 0 for an empty run."""
    out = np.zeros(len(sizes), U64)
    some = np.flatnonzero(sizes)
    if len(some):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, (np.cumsum(sizes) - sizes)[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > sizes[some][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints_of(s, width: int = WIDTH) -> np.ndarray:
    """Fingerprint of each text of a lower-cased slab."""
    import xxhash

    texts, n = len(s.words) - 1, np.diff(s.words)
    inside = ~SPACE[s.data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one space after each word
    place = np.cumsum(keep) - 1
    clean = s.data[keep]
    clean[~inside[keep]] = 0x20
    data = clean.tobytes()
    shingles = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
    at = np.concatenate([[0], np.cumsum(shingles)])
    row = np.repeat(np.arange(texts), shingles)
    first = s.words[:-1][row] + np.arange(at[-1]) - at[:-1][row]
    last = np.minimum(first + width, s.words[1:][row]) - 1
    digest = xxhash.xxh64_intdigest
    begin, end = place[s.start[first]].tolist(), (place[s.end[last] - 1] + 1).tolist()
    h = np.array([digest(data[a:b], SEED) for a, b in zip(begin, end)], "<u8")
    return majority(h, shingles)


def fingerprints(docs: DataFrame, keep: Sequence[str] = ("doc_id",), width: int = WIDTH) -> DataFrame:
    """Columns ``keep`` and ``fp`` (64 bits as long) of the column ``text``."""
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def read(batches):
        for batch in batches:
            for lo, hi, s in slabs(batch.column(0), lower=True):
                own = [batch.column(i + 1).slice(lo, hi - lo) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(fingerprints_of(s, width).view(np.int64))], names=[*(f.name for f in kept), "fp"])

    out = frame.mapInArrow(read, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "fp long"]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "fp")


def index_plan(bits: Sequence[int], distance: int, segments: int) -> list[tuple[list[int], int]]:
    """(bit positions, radius) of each segment: the radii + 1 add up to distance + 1."""
    parts = [list(x) for x in np.array_split(np.array(bits), segments)]
    radii = [(distance + 1) // segments - 1 + (i < (distance + 1) % segments) for i in range(segments)]
    return [(p, r) for p, r in zip(parts, radii) if r >= 0]


def ball(bits: Sequence[int], radius: int) -> list[int]:
    """Masks of at most ``radius`` of these bits, 0 first."""
    masks, layer = [0], [(0, -1)]
    for _ in range(radius):
        layer = [(m | 1 << int(b), i) for m, last in layer for i, b in enumerate(bits) if i > last]
        masks += [m for m, _ in layer]
    return masks


def _mask(bits: Sequence[int]) -> U64:
    return U64(sum(1 << int(b) for b in bits))


def forest(fps: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what is connected among these fingerprints: one less than each part has."""
    left = np.unique(fps)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            fp = queue.pop()
            near = np.bitwise_count(left ^ fp) <= distance
            if near.any():
                found, left = left[near], left[~near]
                queue.extend(found)
                yield np.full(len(found), fp), found


def run_links(keys: np.ndarray, fps: np.ndarray, distance: int, free: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among those with equal keys (ascending); ``free``: the bits that the keys don't fix."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    small = np.repeat(size <= PAIRS_UP_TO, size)
    for step in range(1, min(PAIRS_UP_TO, len(keys))):
        at = np.flatnonzero((keys[step:] == keys[:-step]) & small[step:])
        if not len(at):
            break
        a, b = fps[at], fps[at + step]
        near = (np.bitwise_count(a ^ b) <= distance) & (a != b)
        yield a[near], b[near]
    for i in np.flatnonzero(size > PAIRS_UP_TO):
        run = np.unique(fps[first[i]:first[i] + size[i]])
        if len(run) < AGAIN_FROM or len(free) < 3 * SEGMENTS:
            yield from forest(run, distance)
            continue
        for bits, radius in index_plan(free, distance, SEGMENTS):
            rest = [b for b in free if b not in bits]
            own = run & _mask(bits)
            for mask in ball(bits, radius):
                both = np.concatenate([own, own ^ U64(mask)]) if mask else own
                of = np.concatenate([run, run]) if mask else run
                order = np.argsort(both, kind="stable")
                yield from run_links(both[order], of[order], distance, rest)


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """``fps`` (fp, distinct) to links (a, b) that connect all that differ in at most ``distance`` bits."""
    plan = index_plan(range(64), distance, segments)

    def entries(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(U64)
            for k, (bits, radius) in enumerate(plan):
                own = fp & _mask(bits)
                for mask in ball(bits, radius):
                    value = (own ^ U64(mask)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(value), batch.column(0)], names=["segment", "value", "fp"])

    def compare(batches):
        held = None  # the last run may go on in the next batch
        for batch in batches:
            part = [np.asarray(batch.column(i)) for i in range(3)]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            new = np.flatnonzero((np.diff(part[0]) != 0) | (np.diff(part[1]) != 0))
            cut = int(new[-1]) + 1 if len(new) else 0
            held = [x[cut:] for x in part]
            yield from found([x[:cut] for x in part])
        if held is not None:
            yield from found(held)

    def found(part):
        for k, (bits, _) in enumerate(plan):
            own = part[0] == k
            if own.any():
                free = [b for b in range(64) if b not in set(map(int, bits))]
                for a, b in run_links(part[1][own], part[2][own].view(U64), distance, free):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    table = fps.select("fp").mapInArrow(entries, "segment int, value long, fp long")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(n, "segment", "value").sortWithinPartitions("segment", "value").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, keep: Sequence[str] = (), doc_id: str = "doc_id", width: int = WIDTH,
                    distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """One row per row of ``docs``: columns ``keep``, fingerprint (16 hex digits), component_id, and root (the least
    fingerprint, as a signed number, of the component: it names it even if no row in it has an id)."""
    found = fingerprints(docs.select("text", F.col(doc_id).alias("_id"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)]),
                         ("_id", *[f"_c{i}" for i in range(len(keep))]), width)
    rows = stage(found, "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("_id").alias("least")), "nodes")
    roots = components(links(nodes, distance, segments))
    nodes = stage(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    names = stage(nodes.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id")), "names")
    classes = stage(nodes.join(names, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id", "root"), "classes")
    return rows.join(classes, F.col("fp") == F.col("f")).select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")
