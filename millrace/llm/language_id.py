"""Language ID: words first, shorter and shorter character n-grams for words not met in training.

A word is a run of letters of the lower-cased text. For each language the training texts give the counts of
words, and of the character n-grams (5 to 1) of the words with a mark at both ends. They are stored as
sorted hash arrays in the shared folder and memory-mapped by the workers.

A word met in training adds, for each language, the logarithm of its smoothed frequency there. Any other
word is taken apart into 5-grams; a 5-gram not met is replaced by the 4-grams in it, and so on; each n-gram adds its
smoothed log frequency among the n-grams of its order, and the word the mean of its n-grams. A text's language
is the one with the greatest sum (the first by code point of equal ones), and its score the share of that
language in the sum of exponents (softmax) of the sums.

Null texts and texts without letters are ``und`` with score 0, and so is everything if nothing could be learned.
Training rows without language are left out. Every word and n-gram of every training text counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import tables
from millrace.llm.text import U64, buffers, mix, slices

ORDERS = (5, 4, 3, 2, 1)
SMOOTH = 0.5
STEP = 30_000  # words spelled out at a time
HELD_WORDS = 300_000
SLAB = 2 << 20
KIND_AT = 16  # the kind is written over these bits of a hash: 0 for words, n for n-grams
LETTERS = regex.compile(r"\p{L}+")
BLOCKS = "bucket long, block binary"


class Model(NamedTuple):
    folder: str
    bits: int
    low: int  # bits of a key that tell the language
    languages: tuple[str, ...]
    totals: tuple[tuple[float, ...], ...]  # by kind (0: words, n: n-grams) and language
    distinct: tuple[int, ...]  # by kind


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _marked(h: np.ndarray, kind: int) -> np.ndarray:
    return h & ~U64(7 << KIND_AT) | U64(kind << KIND_AT)


def word_keys(words: list[str]) -> np.ndarray:
    return _marked(np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) for w in words], U64), 0)


class Grams:
    """Hashes of all n-grams of a list of words; ``word`` tells whose they are, ``at`` where they start."""

    def __init__(self, words: list[str]):
        marked = [f"\x02{w}\x03" for w in words]
        self.size = np.array([len(w) for w in marked], np.int64)
        self.code = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(U64)
        self.first = np.cumsum(self.size) - self.size

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count = np.maximum(self.size - n + 1, 0)
        word = np.repeat(np.arange(len(self.size)), count)
        at = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count)
        place = self.first[word] + at
        h = np.full(len(word), n, U64)
        for i in range(n):
            h = mix(h * U64(0x9E3779B97F4A7C15) + self.code[place + i])
        return _marked(h, n), word, at


def _rows(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int64()), ("block", pa.binary())]))


def train(docs: DataFrame, lang: str = "lang", folder: str | None = None) -> Model:
    """A model of the columns ``text`` and ``lang``; rows without language teach nothing."""
    frame = docs.where(F.col(lang).isNotNull()).select("text", F.col(lang).alias("lang"))
    languages = tuple(sorted(r[0] for r in frame.select("lang").distinct().collect()))  # language names, not rows
    low = max(1, (len(languages) - 1).bit_length())  # bits of a key that hold the language
    bits = tables.bucket_bits(frame)
    folder = tables.new_folder(docs.sparkSession, "language", folder)

    def count_words(batches):
        held = tables.Counter(bits)
        words: list[Counter] = [Counter() for _ in languages]
        number = {x: i for i, x in enumerate(languages)}

        def spell_out():
            for language, counter in enumerate(words):
                names = list(counter)
                for i in range(0, len(names), STEP):
                    part = names[i:i + STEP]
                    n = np.array([counter[w] for w in part], np.int64)
                    grams = Grams(part)
                    for h, of in ((word_keys(part), None), *(grams.of(k)[:2] for k in ORDERS)):
                        yield from _rows(held.add(h >> U64(low) << U64(low) | U64(language), n if of is None else n[of]))
                counter.clear()

        for batch in batches:
            for text, language in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[number[language]].update(words_of(text))
            if sum(map(len, words)) > HELD_WORDS:
                yield from spell_out()
        yield from spell_out()
        yield from _rows(held.flush())

    def store(pdf):
        keys, n = tables.merge(pdf["block"])
        own = keys >> U64(low)
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts = np.zeros((len(first), len(languages)), np.int64)
        row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(own))))
        counts[row, (keys & U64((1 << low) - 1)).astype(np.int64)] = n
        tables.save(folder, "seen", int(pdf["bucket"].iloc[0]), key=own[first] << U64(low), count=counts.astype(np.uint32 if counts.max() < 2**32 else np.int64))
        kind = (own[first] >> U64(KIND_AT - low) & U64(7)).astype(np.int64)
        return pd.DataFrame([{"kind": k, "n": int((kind == k).sum()), "totals": counts[kind == k].sum(0).tolist()} for k in np.unique(kind)])

    found = frame.mapInArrow(count_words, BLOCKS).groupBy("bucket").applyInPandas(store, "kind int, n long, totals array<long>").collect()  # some rows per bucket
    kinds = range(max(ORDERS) + 1)
    totals = tuple(tuple(float(sum(r["totals"][i] for r in found if r["kind"] == k)) for i in range(len(languages))) for k in kinds)
    return Model(folder, bits, low, languages, totals, tuple(sum(r["n"] for r in found if r["kind"] == k) for k in kinds))


def _logs(h: np.ndarray, kind: int, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(log frequency by language, whether met in training) of each hash."""
    keys, back = np.unique(h >> U64(m.low) << U64(m.low), return_inverse=True)
    n = tables.lookup(m.folder, "seen", m.bits, keys, {"count": (np.int64, 0, len(m.languages))})["count"]
    logs = np.log((n + SMOOTH) / (np.array(m.totals[kind]) + SMOOTH * (m.distinct[kind] + 1)))
    return logs[back], (n.sum(1) > 0)[back]


def word_logs(words: list[str], m: Model) -> np.ndarray:
    """What each word adds for each language."""
    logs, met = _logs(word_keys(words), 0, m)
    new = np.flatnonzero(~met)
    if not len(new):
        return logs
    grams = Grams([words[i] for i in new.tolist()])
    sums, n = np.zeros((len(new), len(m.languages))), np.zeros(len(new))
    longest = np.minimum(grams.size, max(ORDERS))
    need = np.zeros(len(grams.code) + 1, bool)
    for order in ORDERS:
        h, word, at = grams.of(order)
        place = grams.first[word] + at
        wanted = need[place] | (longest[word] == order)
        h, word, place = h[wanted], word[wanted], place[wanted]
        need = np.zeros(len(grams.code) + 1, bool)
        if not len(h):
            continue
        own, found = _logs(h, order, m)
        np.add.at(sums, word[found], own[found])
        n += np.bincount(word[found], minlength=len(new))
        need[place[~found]] = True
        need[place[~found] + 1] = True
    logs[new] = sums / np.maximum(n, 1)[:, None]
    return logs


def predict(docs: DataFrame, m: Model, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, lang_pred and score of the column ``text``."""
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def predict_texts(batches):
        for batch in batches:
            for lo, hi in slices(buffers(batch.column(0))[1], SLAB):
                words = [words_of(t) for t in batch.column(0).slice(lo, hi - lo).to_pylist()]
                some = np.array([len(w) > 0 for w in words]) & (sum(m.totals[0]) > 0 if m.totals else False)
                names = np.full(hi - lo, "und", object)
                score = np.zeros(hi - lo)
                if some.any():
                    used = [w for w, x in zip(words, some) if x]
                    code, different = pd.factorize(np.array([w for own in used for w in own], object))
                    at = np.cumsum([0, *map(len, used[:-1])])
                    sums = np.add.reduceat(word_logs(list(different), m)[code], at, axis=0)
                    best = sums.argmax(1)
                    names[some] = np.array(m.languages, object)[best]
                    score[some] = 1 / np.exp(sums - sums.max(1, keepdims=True)).sum(1)
                own = [batch.column(i + 1).slice(lo, hi - lo) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(names, pa.string()), pa.array(score)], names=[*(f.name for f in kept), "lang_pred", "score"])

    out = frame.mapInArrow(predict_texts, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double"]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")
