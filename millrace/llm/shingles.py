"""Near-duplicates by SimHash, checked by the exact similarity of their shingle sets.

* **Sets.** Words of the lower-cased (A-Z) text, shingles of ``WIDTH`` words as 64-bit hashes, without repeats; fewer words
  make one shingle, none the empty set. Rows of equal sets are one node, named by a hash of the set. Two nodes
  are linked if the shared part of their sets is at least 4/5 of the union.
* **Partners.** Shingles are counted over all rows and ordered by (count, hash). Two sets that are linked share 4/5 of the
  larger one at least, so both have a shingle in common among the first n - ceil(4n/5) + 1 of n: these are a set's entries. Shingles
  that occur once have no partner and are left out; a set without entries has no link and goes no further.
* **SimHash.** Sets with entries get a fingerprint, and those whose fingerprints are connected by at most ``DISTANCE`` differing
  bits (multi-index hashing, ``simhash.links``) are compared by whole sets in blocks. What is linked there is one class.
* **Rest.** Sets at the limit differ in about ten bits and more, which no index of balls holds, so fingerprints alone would
  lose links. What shares an entry with another class is one candidate group, found by stars of classes and their components.
  An entry held within one class is settled and asks for no comparison. Groups are compared by whole sets in blocks of
  about ``BLOCK`` sets, each with the group's least node. What a block or a class connects with that node
  is connected in all blocks; only the others are compared with every block again. Only links of a forest leave a task.

Null texts count as empty; empty sets are one node. Nothing is capped or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import simhash, tables
from millrace.llm.graph import components
from millrace.llm.suffix_dedup import BLOCKS, _batch
from millrace.llm.text import U64, giving_back, mix, slabs, word_hash
from millrace.session import stage

WIDTH = 5
BLOCK = 256
BLOCK_BYTES = 8 << 20
DISTANCE = 7
#: (up to so many fingerprints, segments): with four, a segment's values are 2^16 and hold ever more fingerprints; three
#: have 2^21 and seven times the entries.
SEGMENTS = ((1_000_000, 4), (None, 3))


def shingle_sets(s, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the distinct shingles of each text of a lower-cased slab, in order."""
    words, n = word_hash(s), np.diff(s.words)
    size = np.where(n > 0, np.maximum(n - width + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), size)
    first = s.words[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    end = s.words[1:][row]
    h = np.zeros(len(row), U64)
    for i in range(width):
        inside = np.flatnonzero(first + i < end)
        h[inside] = mix(h[inside] * U64(3) + words[first[inside] + i])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    if len(h):
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])
        row, h = row[new], h[new]
    return h, np.searchsorted(row, np.arange(len(n) + 1))


def _digests(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(h[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], U64).view(np.int64)


def similar(sets: Sequence[np.ndarray], classes: np.ndarray | None = None) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links of a forest among these sets (none empty), and the first set that each is connected with; sets of one class
    are connected already."""
    n = np.array([len(x) for x in sets])
    classes = np.arange(len(n)) if classes is None else classes
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    at = np.concatenate([[0], np.cumsum(n)])
    label, links = np.full(len(n), -1), []
    for seed in range(len(n)):
        if label[seed] >= 0:
            continue
        label[seed], queue = seed, [seed]
        while queue and (label < 0).any():
            v = queue.pop()
            kin = np.flatnonzero((label < 0) & (classes == classes[v]))
            label[kin] = seed
            queue.extend(kin.tolist())
            own = np.zeros(int(ids.max()) + 1, np.int64)
            own[ids[at[v]:at[v + 1]]] = 1
            both = np.add.reduceat(own[ids], at[:-1])
            near = np.flatnonzero((label < 0) & (5 * both >= 4 * (n + n[v] - both)))
            label[near] = seed
            queue.extend(near.tolist())
            links += [(v, x) for x in near.tolist()]
    return links, label


def _each(n: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(n) - 1))


def _block_of(n: str) -> Column:
    return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")


def _blocks(block: int, block_bytes: int, size: str = "bytes") -> Column:
    """How many blocks the sets of a group make."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum(F.col(size).cast("long")) / block_bytes)).cast("int")


def _compare(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of one block of a group; with more than one block, those not connected with the least node as links with themselves."""
    pdf = pdf.drop_duplicates("node")
    nodes = pdf["node"].to_numpy()
    first = np.argsort(nodes != pdf["root"].to_numpy(), kind="stable")  # the least node, if it is here
    nodes, texts = nodes[first], [np.frombuffer(x, U64) for x in pdf["shingles"].iloc[first]]
    forest, label = similar(texts, pdf["class"].to_numpy()[first])
    a, b = np.array(forest, np.int64).reshape(-1, 2).T  # whole numbers also when there is no link
    if pdf["blocks"].iloc[0] > 1:
        far = np.flatnonzero(label != 0)
        a, b = np.concatenate([a, far]), np.concatenate([b, far])
    return pd.DataFrame({"root": pdf["root"].iloc[0], "a": nodes[a], "b": nodes[b]})


LINKS = "root long, a long, b long"
MEMBER = ("root", "node", "class", "shingles")


def _in_blocks(dealt: DataFrame, far: bool) -> DataFrame:
    """Compare groups (``MEMBER``, blocks) block by block, each with the least node; ``far``: name those that it isn't connected with."""
    blocks = F.col("blocks") if far else F.lit(1).alias("blocks")
    rest = dealt.where("node <> root").select(*MEMBER, blocks, _block_of("blocks").alias("block"))
    heads = dealt.where("node = root").select(*MEMBER, blocks, _each("blocks").alias("block"))
    return rest.unionByName(heads).groupBy("root", "block").applyInPandas(_compare, LINKS)


def by_fingerprint(sets: DataFrame, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links (a, b) of ``sets`` (node, shingles, fp) that SimHash proposes and the whole sets confirm."""
    fps = stage(sets.select("fp").distinct(), "fps")
    n = fps.count()
    segments = next(k for most, k in SEGMENTS if most is None or n <= most)
    roots = components(simhash.links(fps, DISTANCE, segments)).select(F.col("node").alias("_f"), F.col("root").alias("_g"))
    kinds = stage(sets.join(roots, F.col("fp") == F.col("_f"), "left").select(
        "node", F.coalesce("_g", "fp").alias("kind"), F.octet_length("shingles").alias("bytes")), "kinds")
    sizes = kinds.groupBy(F.col("kind").alias("_k")).agg(F.min("node").alias("root"), _blocks(block, block_bytes).alias("blocks"), F.count(F.lit(1)).alias("_n"))
    members = stage(kinds.join(sizes.where("_n > 1"), F.col("kind") == F.col("_k")).select(F.col("node").alias("_m"), "root", "blocks"), "members")
    dealt = sets.join(members, F.col("node") == F.col("_m")).select("root", "node", F.col("node").alias("class"), "shingles", "blocks")
    return stage(_in_blocks(dealt, far=False).select("a", "b"), "alike")


def sets_with_entries(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the column ``text`` that have entries: node, fp, shingles (the whole set), entries."""
    frame = docs.select("text")
    folder = tables.new_folder(docs.sparkSession, "shingles")
    bits = tables.bucket_bits(frame) + 2  # nearly every word makes an entry: smaller buckets

    def count(batches):
        held = tables.Counter(bits, 400_000)
        for batch in batches:
            for _, _, s in slabs(batch.column(0), lower=True):
                yield from _batch(held.add(shingle_sets(s, width)[0]))
        yield from _batch(held.flush())

    def store(pdf):
        keys, counts = tables.merge(pdf["block"])
        many = counts > 1
        tables.save(folder, "shingle", int(pdf["bucket"].iloc[0]), key=keys[many], count=counts[many])
        return pd.DataFrame({"n": [int(many.sum())]})

    frame.mapInArrow(giving_back(count), BLOCKS).groupBy("bucket").applyInPandas(store, "n long").agg(F.sum("n")).collect()

    def entries(batches):
        for batch in batches:
            for _, _, s in slabs(batch.column(0), lower=True):
                h, bounds = shingle_sets(s, width)
                keys, back = np.unique(h, return_inverse=True)
                times = tables.lookup(folder, "shingle", bits, keys, {"count": (np.int64, 1)})["count"][back]
                n = np.diff(bounds)
                row = np.repeat(np.arange(len(n)), n)
                order = np.lexsort((h, times, row))
                place = np.arange(len(h)) - bounds[:-1][row]
                order = order[(place < (n - (4 * n + 4) // 5 + 1)[row]) & (times[order] > 1)]
                rows = np.unique(row[order])
                cuts = np.searchsorted(row[order], [*rows, len(n)])
                own = [h[bounds[r]:bounds[r + 1]] for r in rows.tolist()]
                shared = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(h[order].view(np.int64)))
                nodes = np.array([xxhash.xxh64_intdigest(x) for x in own], U64).view(np.int64)
                fps = simhash.majority(np.concatenate([h[:0], *own]), n[rows]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(fps), pa.array([x.tobytes() for x in own], pa.binary()), shared], names=["node", "fp", "shingles", "entries"])
        tables.load.cache_clear()  # no later step of this worker reads them

    found = frame.mapInArrow(giving_back(entries), "node long, fp long, shingles binary, entries array<long>")
    return stage(found.groupBy("node").agg(*[F.first(c).alias(c) for c in ("fp", "shingles", "entries")]), "sets")


def links(docs: DataFrame, width: int = WIDTH, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links (a, b) of the nodes of the column ``text`` that connect all that are similar."""
    sets = sets_with_entries(docs, width)
    alike = by_fingerprint(sets, block, block_bytes)
    known = stage(components(alike).select(F.col("node").alias("_n"), F.col("root").alias("_c")), "known")
    classed = stage(sets.join(known, F.col("node") == F.col("_n"), "left").select("node", F.coalesce("_c", "node").alias("class"), F.octet_length("shingles").alias("bytes"), "entries"), "classed")
    single = stage(classed.select("class", F.explode("entries").alias("shingle")).distinct(), "entries")
    least = stage(single.groupBy(F.col("shingle").alias("s")).agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "least")
    stars = single.join(least, F.col("shingle") == F.col("s")).select(F.col("class").alias("a"), F.col("least").alias("b"))
    roots = components(stars).select(F.col("node").alias("_n"), "root")
    groups = stage(classed.join(roots, F.col("class") == F.col("_n"), "left").select(F.coalesce("root", "class").alias("root"), "node", "class", "bytes"), "groups")
    # a group of one class is settled, and its sets stay where they are
    sizes = groups.groupBy(F.col("root").alias("_r")).agg(_blocks(block, block_bytes).alias("blocks"), F.min("class").alias("_least"), F.max("class").alias("_most"))
    members = stage(groups.join(sizes.where("_least <> _most"), F.col("root") == F.col("_r")).select(F.col("node").alias("_m"), "root", "class", "bytes", "blocks"), "members")
    dealt = stage(sets.select("node", "shingles").join(members, F.col("node") == F.col("_m")).select(*MEMBER, "bytes", "blocks"), "dealt")

    inside = stage(_in_blocks(dealt, far=True), "inside")
    far = stage(inside.where("a = b").select("root", F.col("a").alias("_f")), "far")
    found = alike.unionByName(inside.where("a <> b").select("a", "b"))
    if far.isEmpty():
        return found
    open_ = stage(dealt.join(far.select("_f"), F.col("node") == F.col("_f"), "left_semi"), "open")
    open_sizes = stage(open_.groupBy(F.col("root").alias("_o")).agg(_blocks(block, block_bytes).alias("parts")), "open-sizes")
    part_of = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int").alias("part")
    mine = open_.join(open_sizes, F.col("root") == F.col("_o")).select(*MEMBER, F.lit(1).alias("blocks"), part_of, _each("blocks").alias("block"))
    others = dealt.join(open_sizes, F.col("root") == F.col("_o")).select(*MEMBER, F.lit(1).alias("blocks"), _each("parts").alias("part"), _block_of("blocks").alias("block"))
    across = mine.unionByName(others).groupBy("root", "part", "block").applyInPandas(_compare, LINKS)
    return found.unionByName(stage(across, "across").select("a", "b"))


def near_duplicates(docs: DataFrame, keep: Sequence[str] = ("doc_id",), width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: columns ``keep``, node (a hash of the row's set) and root (the least node that is
    connected with it)."""
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def read(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, s in slabs(batch.column(0), lower=True):
                own = [batch.column(i + 1).slice(lo, hi - lo) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(_digests(*shingle_sets(s, width)))], names=[*(f.name for f in kept), "node"])

    rows = stage(frame.mapInArrow(giving_back(read), ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "node long"])), "nodes")
    roots = stage(components(links(docs, width, block)).select(F.col("node").alias("_n"), "root"), "roots")
    return rows.join(roots, F.col("node") == F.col("_n"), "left").select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "node", F.coalesce("root", "node").alias("root"))
