"""LM scoring: an interpolated modified Kneser-Ney bigram model.

Counted in Spark, stored as sorted hash arrays, memory-mapped by the workers.

* Tokens are the words of the lower-cased (A-Z) text and one end mark after them. The end mark
  also is the context of a text's first word.
* ``uni``: the hash of each training word with its count; a word's id is its place in these sorted
  arrays. ``bi``: a bijective hash of (context id, word id) with its count, so bigrams are exact.
  ``uni`` also gets, by id, the number of different words before the word, and of its followers seen
  once, twice and more often, which is what the discounts and the back-off weights need.
* The model has two orders. On text of this kind over four fifths of all trigrams are seen once, and
  their counts alone exceed the input; the bigram holds what copies and shared passages give away.

Every count covers all training texts; nothing is pruned. A word unseen in training has the
probability that the continuation counts leave over, divided by the distinct tokens + 1.
Empty and null texts are one end mark. No training text at all: every token is unseen, probability 1
of a vocabulary of one. Rows with equal or null ids are scored like all others.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import tables
from millrace.llm.text import U64, count_unique, mix, slabs, total, unmix, word_hash

END = U64(0x2545F4914F6CDD1D)  # hash of the end mark
SLAB = 2 << 20
BLOCKS = "bucket long, block binary"


class Model(NamedTuple):
    folder: str
    uni_bits: int
    bi_bits: int
    first_id: tuple[int, ...]  # id of each bucket's first word
    tokens: int  # all training tokens
    distinct: int  # distinct training tokens
    bigrams: int  # distinct bigrams
    discounts: tuple[float, float, float]
    lower_discounts: tuple[float, float, float]
    left_over: float  # what the discounts take from all continuation counts


def _tokens(s) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token with the end marks, index of each text's first token)."""
    h, n = word_hash(s), len(s.words) - 1
    at = s.words + np.arange(n + 1)
    out = np.full(len(h) + n, END, U64)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = h
    return out, at


def _ids(h: np.ndarray, m: Model, extra: dict) -> dict[str, np.ndarray]:
    """Ids (-1: unseen) and further ``uni`` columns of the token hashes."""
    keys, back = np.unique(h, return_inverse=True)
    got = tables.lookup(m.folder, "uni", m.uni_bits, keys, {"at": (np.int64, -1)} | extra)
    bucket = np.searchsorted(tables.edges(m.uni_bits), keys, "right")
    got["id"] = np.where(got["at"] < 0, -1, got["at"] + np.array(m.first_id)[bucket])
    return {c: v[back] for c, v in got.items()}


def _rows(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("block", pa.binary())]))


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the number of entries seen 1 to 4 times."""
    n1, n2, n3, n4 = (max(x, 0) for x in n)
    if not n1 or not n2:
        return 0.5, 0.75, 0.9  # too little text to estimate them
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), k) for d, k in ((d1, 0.95), (d2, 1.9), (d3, 2.9)))


def _of_counts(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)]


def train(docs: DataFrame, folder: str | None = None) -> Model:
    """A model of the column ``text`` of ``docs``. ``folder``: a path that all nodes mount; the default
    is the shared folder of the session."""
    spark = docs.sparkSession
    texts = docs.select("text")
    bi_bits = tables.bucket_bits(texts)
    uni_bits = max(6, bi_bits - 2)
    folder = tables.new_folder(spark, "ngram", folder)
    none = Model(folder, uni_bits, bi_bits, (), 0, 0, 0, (0, 0, 0), (0, 0, 0), 0)

    def count_words(batches):
        held = tables.Counter(uni_bits)
        for batch in batches:
            for _, _, s in slabs(batch.column(0), lower=True, limit=SLAB):
                yield from _rows(held.add(_tokens(s)[0]))
        yield from _rows(held.flush())

    def store_words(pdf):
        keys, counts = tables.merge(pdf["block"])
        bucket = int(pdf["bucket"].iloc[0])
        tables.save(folder, "uni", bucket, key=keys, count=counts)
        return _frame({"bucket": [bucket], "n": [len(keys)], "sum": [int(counts.sum())]})

    words = (
        texts.mapInArrow(count_words, BLOCKS).groupBy("bucket")
        .applyInPandas(store_words, "bucket long, n long, sum long").collect()  # one row per bucket
    )
    sizes = np.zeros(1 << uni_bits, np.int64)
    for r in words:
        sizes[r["bucket"]] = r["n"]
    m = none._replace(first_id=tuple(int(x) for x in np.concatenate([[0], np.cumsum(sizes)[:-1]])),
                      tokens=sum(r["sum"] for r in words), distinct=int(sizes.sum()))

    def count_pairs(batches):
        held = tables.Counter(bi_bits)
        for batch in batches:
            for _, _, s in slabs(batch.column(0), lower=True, limit=SLAB):
                h, _ = _tokens(s)
                yield from _rows(held.add(_pairs(h, m)))
        yield from _rows(held.flush())

    def store_pairs(pdf):
        keys, counts = tables.merge(pdf["block"])
        bucket = int(pdf["bucket"].iloc[0])
        once = counts == 1
        tables.save(folder, "once", bucket, key=keys[once])
        tables.save(folder, "more", bucket, key=keys[~once], count=counts[~once])
        pairs = unmix(keys)
        rows = [{"bucket": -1, "block": np.array([*_of_counts(counts), len(keys)], np.int64).tobytes()}]
        for kind, ids in (("after", pairs & U64(0xFFFFFFFF)), *((f"n{k}", (pairs >> U64(32))[(counts == k) if k < 3 else (counts > 2)]) for k in (1, 2, 3))):
            ids, n = count_unique(ids)
            cuts = [*np.searchsorted(ids, np.array(m.first_id, U64)), len(ids)]
            for b, (x, y) in enumerate(zip(cuts, cuts[1:])):
                if x < y:
                    rows.append({"bucket": KINDS.index(kind) << 40 | b, "block": tables.pack(ids[x:y], n[x:y])})
        return _frame({"bucket": [r["bucket"] for r in rows], "block": [r["block"] for r in rows]})

    def store_followers(pdf):
        code = int(pdf["bucket"].iloc[0])
        if code < 0:
            sums = sum(np.frombuffer(b, np.int64) for b in pdf["block"])
            return _frame({"kind": ["bi"], "n": [[int(x) for x in sums]]})
        ids, n = tables.merge(pdf["block"])
        kind, bucket = KINDS[code >> 40], code & ((1 << 40) - 1)
        values = np.zeros(sizes[bucket], np.int64)
        values[ids.astype(np.int64) - m.first_id[bucket]] = n
        tables.save(folder, "uni", bucket, **{kind: values.astype(np.uint32 if values.max() < 2**32 else np.int64)})
        return _frame({"kind": [kind], "n": [[*_of_counts(n), len(n)]]})

    found = (
        texts.mapInArrow(count_pairs, BLOCKS).groupBy("bucket").applyInPandas(store_pairs, BLOCKS)
        .groupBy("bucket").applyInPandas(store_followers, "kind string, n array<long>").collect()  # one row per bucket
    )
    of = {k: [sum(c) for c in zip(*(r["n"] for r in found if r["kind"] == k))] for k in ("bi", "after")}
    if not m.tokens:
        return m
    lower = _discounts(of["after"][:4])
    n1, n2, _, _, n = of["after"]
    return m._replace(bigrams=of["bi"][4], discounts=_discounts(of["bi"][:4]), lower_discounts=lower,
                      left_over=lower[0] * n1 + lower[1] * n2 + lower[2] * (n - n1 - n2))


KINDS = ["after", "n1", "n2", "n3"]


def _frame(columns: dict):
    import pandas as pd

    return pd.DataFrame(columns)


def _pairs(h: np.ndarray, m: Model) -> np.ndarray:
    ids = _ids(np.concatenate([h, [END]]), m, {})["id"].astype(U64)
    return mix(np.concatenate([ids[-1:], ids[:-2]]) << U64(32) | ids[:-1])


def _scored(h: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log10 of the model's and of the base's probability, count) of each token."""
    columns = {"count": (np.int64, 0), **{k: (np.int64, 0) for k in KINDS}}
    got = _ids(np.concatenate([h, [END]]), m, columns)
    context = {k: np.concatenate([v[-1:], v[:-2]]) for k, v in got.items()}
    got = {k: v[:-1] for k, v in got.items()}
    known = (got["id"] >= 0) & (context["id"] >= 0)
    pairs = np.zeros(len(h), U64)
    pairs[known] = mix(context["id"][known].astype(U64) << U64(32) | got["id"][known].astype(U64))
    keys, back = np.unique(pairs[known], return_inverse=True)
    once = tables.lookup(m.folder, "once", m.bi_bits, keys, {"at": (np.int64, -1)})["at"] >= 0
    more = tables.lookup(m.folder, "more", m.bi_bits, keys, {"count": (np.int64, 0)})["count"]
    seen = np.zeros(len(h), np.int64)
    seen[known] = (more + once)[back]

    def cut(counts, d):
        return np.maximum(counts - np.array([0, *d])[np.minimum(counts, 3)], 0)

    # the lower order: continuation counts, interpolated with 1 / (distinct + 1)
    after, d = got["after"], m.lower_discounts
    lower = (cut(after, d) + m.left_over / (m.distinct + 1)) / m.bigrams
    n = context["count"]
    weight = sum(x * context[k] for x, k in zip(m.discounts, KINDS[1:]))
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(n > 0, (cut(seen, m.discounts) + weight * lower) / n, lower)
    base = (got["count"] + 0.5) / (m.tokens + 0.5 * (m.distinct + 1))
    return np.log10(p), np.log10(base), got["count"]


def score(docs: DataFrame, m: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` and n_tokens, n_known, train_tokens, base_score, score, perplexity of each text."""
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def score_texts(batches):
        for batch in batches:
            for lo, hi, s in slabs(batch.column(0), lower=True, limit=SLAB):
                h, at = _tokens(s)
                if m.tokens:
                    p, base, count = _scored(h, m)
                else:
                    p, base, count = np.zeros(len(h)), np.zeros(len(h)), np.zeros(len(h), np.int64)
                n, score = np.diff(at), _sums(p, at)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i + 1).slice(lo, hi - lo) for i in range(len(kept))), pa.array(n), pa.array(total(count > 0, at)),
                     pa.array(np.full(len(n), m.tokens)), pa.array(_sums(base, at)), pa.array(score), pa.array(10 ** (-score / n))],
                    names=[*(f.name for f in kept), *OUT])

    types = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), *(f"{c} {t}" for c, t in OUT.items())])
    out = frame.mapInArrow(score_texts, types)
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], *OUT)


OUT = {"n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double", "perplexity": "double"}


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums by text, each added up on its own."""
    return np.add.reduceat(values, at[:-1]) if len(at) > 1 else np.zeros(0)
