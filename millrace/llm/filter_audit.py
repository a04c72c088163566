"""Filter interaction audit: what a chain of filters removes, in every order, from one pass over the documents.

Each document becomes a 32-bit survival word: bit ``s`` is set if the document passes every filter of subset ``s``
of the five. Carry-save adders turn the words of each part and label class into bit planes, whose popcounts by
position are the survivors of each subset. Whatever happens in any order of the filters follows from these 32 numbers:
a step removes the survivors of the filters before it that do not survive them and its own.

Filter E (identical to the text of any smaller id) is the only one that needs other rows. Texts are known by their
SHA-256. The least id of each text comes from an aggregation, and is joined on (text, id), so a large group of copies
meets no single task; rows without an id are dealt by their text in the join with the labels.

Defined results: a null text is empty, a null source is the empty part. A row without id never fails E and makes no
other row fail it, and has no labels. Rows of equal id are documents of their own, but none has a smaller id than the
other. Several labels of one id count as the union. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
SPACE = r"[\x20\x09-\x0D]+"
#: survival word by mask of failed filters (bit i: filter i failed)
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)
#: fewer words than this are counted bit by bit
FEW = 64


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set.

    Carry-save: three words become their bitwise sum and their carries, of twice the weight, until few of each weight are left.
    """
    counts, weight = np.zeros(32, np.int64), 1
    words = np.ascontiguousarray(words, np.uint32)
    while len(words):
        carries = []
        while len(words) > FEW:
            third = len(words) // 3
            a, b, c = words[:third], words[third:2 * third], words[2 * third:3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, words[3 * third:]])
        counts += weight * ((words[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)).sum(0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def survivors(groups: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct groups in order, and for each the survivors of the 32 subsets."""
    order = np.argsort(groups, kind="stable")
    groups, words = groups[order], words[order]
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(groups)))
    counts = np.zeros((len(first), 32), np.int64)
    small = np.repeat(sizes <= FEW, sizes)
    if small.any():  # many small groups at once
        bits = (words[small][:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        few = sizes <= FEW
        counts[few] = np.add.reduceat(bits.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[few])[:-1]]), 0)
    for i in np.flatnonzero(sizes > FEW):
        counts[i] = positional_popcount(words[first[i]:first[i] + sizes[i]])
    return groups[first], counts


def _count(batches):
    """(part, good, toxic, failed) rows to the survivors of each subset, by part and label class of each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part").dictionary_encode()
        failed = batch.column("failed").to_numpy(zero_copy_only=False)
        label = batch.column("good").to_numpy(zero_copy_only=False) * 1 + batch.column("toxic").to_numpy(zero_copy_only=False) * 2
        groups, counts = survivors(part.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + label, WORDS[failed])
        n = len(groups)
        yield pa.RecordBatch.from_arrays([
            part.dictionary.take(pa.array(np.repeat(groups // 4, SUBSETS))),
            pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), n)),
            pa.array(counts.ravel()),
            pa.array((counts * (groups % 2 == 1)[:, None]).ravel()),
            pa.array((counts * (groups % 4 >= 2)[:, None]).ravel()),
        ], names=["part", "subset", "n", "good", "toxic"])


def failures(text: Column) -> Column:
    """Failed filters A to D as a mask.

    A: under 200 words; B: under half of the words are distinct; C: over 2 % capitals; D: holds a sign of ``#$%&*|``.
    """
    pieces = F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ")

    def flags(words):
        n, signs = F.size(words), F.length(text)
        capitals = F.regexp_count(text, F.lit("[A-Z]"))
        rules = (n < 200, 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
                 100 * capitals.cast("long") > 2 * signs.cast("long"), text.rlike(r"[#$%&*|]"))
        return sum((F.when(rule, F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules)), F.lit(0))

    return F.transform(F.array(F.array_remove(pieces, "")), flags)[0]


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, part, good, toxic, failed (mask of all five filters)."""
    text = F.coalesce("text", F.lit(""))
    facts = stage(documents.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(text).alias("failed"),
                                   F.unhex(F.sha2(text, 256)).alias("digest")), "facts")
    first = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # no label has a null id: such rows are dealt by their text
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0).cast("long"))
    rows = facts.join(first, ["digest", "doc_id"], "left").withColumn("spread", spread)
    rows = rows.join(known.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left")
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.select("doc_id", "part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
                       (F.col("failed") + F.when(repeated, 1 << 4).otherwise(0)).alias("failed"))


def survival_counts(rows: DataFrame) -> DataFrame:
    """part, subset, and how many documents (n, good, toxic) pass all filters of the subset."""
    partial = rows.select("part", "good", "toxic", F.col("failed").cast("int")).mapInArrow(
        _count, "part string, subset int, n long, good long, toxic long")
    return partial.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the survivors of the subsets."""
    counts = survival_counts(judged(documents, labels))
    entry = F.struct("subset", F.struct("n", "good", "toxic").alias("v"))
    parts = counts.groupBy("part").agg(F.sort_array(F.collect_list(entry)).alias("by"))  # 32 of each part
    # over all orders, a filter removes what it does after each subset of the others, as often as orders have that subset before it
    ways = {n: math.factorial(n) * math.factorial(len(FILTERS) - 1 - n) for n in range(len(FILTERS))}
    weights = [[ways[s.bit_count()] if not s >> i & 1 else -ways[s.bit_count() - 1] for s in range(SUBSETS)] for i in range(len(FILTERS))]
    shapley = F.transform(F.from_json(F.lit(str(weights)), "array<array<long>>"), lambda own: F.aggregate(
        F.zip_with(F.col("by.v.n"), own, lambda n, w: n * w), F.lit(0).cast("long"), lambda total, v: total + v))
    parts = stage(parts.withColumn("shapley", shapley), "subsets")

    orders = ",".join("".join(o) for o in itertools.permutations(FILTERS))
    rows = parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = [_bit(F.substring("filter_order", i, 1)) for i in range(1, len(FILTERS) + 1)]
    before = sum((F.when(F.col("step") > i, bit).otherwise(0) for i, bit in enumerate(bits, 1)), F.lit(0))
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    rows = rows.withColumns({"b": before, "x": _bit(own), "i": F.ascii(own) - ord(FILTERS[0])}).withColumn("a", F.col("b") + F.col("x"))
    b, a, x, every = F.col("b"), F.col("a"), F.col("x"), SUBSETS - 1
    return rows.select(
        "part", "filter_order", "step", _at(a).alias("kept"), (_at(b) - _at(a)).alias("removed"),
        (_at(0) - _at(x) - _at(b) + _at(a)).alias("redundant"), (_at(every - x) - _at(every)).alias("unique_fails"),
        (_at(b, "good") - _at(a, "good")).alias("good_lost"), (_at(b, "toxic") - _at(a, "toxic")).alias("toxic_lost"),
        F.col("shapley")[F.col("i")].alias("shapley"))


def _bit(letter: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord(FILTERS[0]))


def _at(subset: Column | int, kind: str = "n") -> Column:
    """Survivors of a subset of filters."""
    return F.col("by")[subset]["v"][kind]
