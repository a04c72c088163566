"""Token ids of whole texts with a public vocabulary, each different word encoded once.

For vocabularies that drop white space, as ``word_bpe_49k.json`` does (its pre-tokenizer never joins
what white space parts), the ids of a text are those of its words one after the other. Words are also
parted between ASCII letters and marks, and lower-cased where the vocabulary does it, so that fewer are
different. A worker keeps the ids of the words it has met, up to a fixed number of words, so what a task holds doesn't
grow with the data.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from millrace.llm.text import LOWER, Slab, slabs, word_hash

KEPT_WORDS = 300_000


class Encoder:
    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.lower = "Lowercase" in str(self.tokenizer.normalizer)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word of letters
        self.last[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        # hashes of the words in order, and their places: a dict of as many words takes ten times the memory
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters only, many in a call: where each ends is seen from its last id."""
        ids, _ = self._encoded([" ".join(words[i:i + 256]) for i in range(0, len(words), 256)])
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(words):
            return self._encoded(words)
        return ids, np.diff(ends, prepend=-1)

    def _learn(self, keys: np.ndarray, words: list[str]) -> np.ndarray:
        """Keep the ids of new words, ``keys`` in order; the places of the words."""
        letters = np.array([w.isalpha() for w in words])
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        n = int(letters.sum())
        parts = [f([words[i] for i in x.tolist()]) for f, x in ((self._joined, order[:n]), (self._encoded, order[n:]))]
        ids, sizes = (np.concatenate(x) for x in zip(*parts))
        first = len(self.keys)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(keys) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.size))
        self.ids[self.used:self.used + len(ids)] = ids
        self.size[first:first + len(keys)] = sizes
        self.at[first:first + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        place = np.empty(len(keys), np.int32)
        place[order] = first + np.arange(len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, place)
        return place

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """The places of the words, -1 of those not met."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == keys, self.place[at], -1) if len(self.keys) else np.full(len(keys), -1, np.int32)

    def encode(self, s: Slab) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, index of each text's first id)."""
        keys, first, back = np.unique(word_hash(s), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.kept:
            self._clear()
        place = self._places(keys)
        new = np.flatnonzero(place < 0)
        if len(new):
            data, at = s.data.tobytes(), first[new]
            words = [data[a:b].decode("utf-8", "replace") for a, b in zip(s.start[at].tolist(), s.end[at].tolist())]
            place[new] = self._learn(keys[new], words)
        slot = place[back]
        sizes = self.size[slot]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.at[slot] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[at], ends[s.words]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder: its words serve all tasks that the worker runs."""
    return Encoder(path)


def encoded(column: pa.Array, path: str, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, bounds of each text's ids), with the id ``end`` after each text."""
    coder = encoder(path)
    for lo, hi, s in slabs(column, parts=True):
        if coder.lower and b"<|" not in s.data.tobytes():  # special tokens keep their case
            s = s._replace(data=LOWER[s.data])
        ids, at = coder.encode(s)
        at = at + np.arange(len(at))
        out = np.full(at[-1], end, np.uint32)
        inside = np.ones(len(out), bool)
        inside[at[1:] - 1] = False
        out[inside] = ids
        yield lo, hi, out, at
