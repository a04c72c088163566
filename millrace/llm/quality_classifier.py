"""Quality classifier: histogram gradient-boosted trees over document statistics.

* **Statistics** (``STATS``) are computed for every whole text, from its bytes and words only.
* **Fit.** Labelled rows are joined to the statistics. ``max_rows`` of them (those of the least hash of id,
  a bounded sample; all, if there are fewer) reach the driver, as rows of about 30 numbers. Each statistic is cut at quantiles into up to
  ``bins`` bins; each tree grows by depth from histograms of gradients of the logistic loss.
* **Score.** Trees are complete and flattened into arrays by level, so a batch of rows walks down all of them with
  a few numpy steps per level.

Empty and null texts have statistics like any other (all 0). A label that is null counts as none; several labels of one
id count as their mean, rounded up from a half. Without labels, or with one class only, the score is the share of
label 1 (0.5 without labels). Rows of equal or null id are scored like all others; null ids have no label.
Texts of any length are read whole, in slabs. Empty tables give no rows. Other columns are not looked at: only ``keep``, the id and
the text are read, and inside the names begin with an underscore.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import U64, giving_back, mix, slabs, total, word_hash
from millrace.session import stage

MAX_ROWS = 50_000
THRESHOLD = 0.3

STATS = ("log_bytes", "log_words", "log_lines", "word_bytes", "longest", "upper", "lower", "digit", "space", "high", "newline",
         "mark", "stop", "exclaim", "pipe", "symbol", "markup", "upper_words", "capital_words", "lone_marks", "ends_in_letter",
         "ends_in_stop", "ends_in_symbol", "different", "repeat_next", "repeat_pairs", "repeat_triples", "most_common",
         "duplicate_lines", "short_words")


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_UPPER, _LOWER, _DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class(bytes(range(48, 58)))
_HIGH = _class(bytes(range(128, 256)))
_MARK = _class(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_SYMBOL = _class(b"#*$%&|<>@^~=+\\_")
_BYTES = {"upper": _UPPER, "lower": _LOWER, "digit": _DIGIT, "space": _class(b" \t\r\x0b\x0c"), "high": _HIGH, "newline": _class(b"\n"), "mark": _MARK,
          "stop": _class(b".,;:?"), "exclaim": _class(b"!"), "pipe": _class(b"|"), "symbol": _SYMBOL, "markup": _class(b"<>{}[]()/")}


def _share_repeated(h: np.ndarray, row: np.ndarray, texts: int) -> np.ndarray:
    """How many of each text's hashes occur in it before."""
    key = mix(h ^ mix(row.astype(U64)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(h), bool)
    again[first] = False
    return np.bincount(row[again], minlength=texts)


def stats_of(s) -> np.ndarray:
    """(texts, statistics) of a slab."""
    texts = len(s.words) - 1
    size = np.diff(s.bounds).astype(float)
    words = np.diff(s.words)
    row = np.repeat(np.arange(texts), words)
    bytes_, words_ = np.maximum(size, 1), np.maximum(words, 1).astype(float)
    out = {"log_bytes": np.log1p(size), "log_words": np.log1p(words)}
    for name, table in _BYTES.items():
        out[name] = total(table[s.data], s.bounds)
    lines = out["newline"] + 1.0
    out["log_lines"] = np.log(lines)
    for name in _BYTES:
        out[name] = out[name] / bytes_
    length = s.end - s.start
    first, last = (s.data[s.start], s.data[s.end - 1]) if len(length) else (np.zeros(0, np.uint8),) * 2
    upper = np.concatenate([[0], np.cumsum(_UPPER[s.data])])
    lower = np.concatenate([[0], np.cumsum(_LOWER[s.data])])
    n_upper, n_lower = upper[s.end] - upper[s.start], lower[s.end] - lower[s.start]

    def of_words(flag: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=flag, minlength=texts) / words_

    out["word_bytes"] = of_words(length)
    longest = np.zeros(texts)
    np.maximum.at(longest, row, length)
    out["longest"] = np.log1p(longest)
    out["upper_words"] = of_words((n_upper > 0) & (n_lower == 0) & (length > 1))
    out["capital_words"] = of_words((_UPPER[first] == 1) & (n_lower > 0))
    out["lone_marks"] = of_words((length == 1) & (_MARK[last] == 1))
    out["ends_in_letter"] = of_words((_LOWER[last] | _HIGH[last]) == 1)
    out["ends_in_stop"] = of_words(_BYTES["stop"][last] == 1)
    out["ends_in_symbol"] = of_words((_SYMBOL[last] | _BYTES["exclaim"][last]) == 1)
    out["short_words"] = of_words(length <= 3)
    h = word_hash(s) if len(s.data) else np.zeros(0, U64)
    out["different"] = 1 - _share_repeated(h, row, texts) / words_
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out["repeat_next"] = np.bincount(row[1:][same], minlength=texts) / words_
    for name, n in (("repeat_pairs", 2), ("repeat_triples", 3)):
        chain = h[:len(h) - n + 1].copy() if len(h) >= n else np.zeros(0, U64)
        for i in range(1, n):
            chain = mix(chain + h[i:len(chain) + i])
        inside = row[:len(chain)] == row[n - 1:] if len(chain) else np.zeros(0, bool)
        out[name] = _share_repeated(chain[inside], row[:len(chain)][inside], texts) / words_
    _, back, n = np.unique(mix(h ^ mix(row.astype(U64))), return_inverse=True, return_counts=True)
    most = np.zeros(texts)
    np.maximum.at(most, row, n[back])
    out["most_common"] = most / words_
    # lines: a line's hash is the sum of mixed word hashes and places in it
    breaks = np.concatenate([[0], np.cumsum(s.data == 10)])
    line = breaks[s.start] + row if len(length) else np.zeros(0, np.int64)
    new = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    place = np.arange(len(line)) - np.repeat(new, np.diff(np.append(new, len(line))))
    sums = np.add.reduceat(mix(h + place.astype(U64)), new) if len(new) else np.zeros(0, U64)
    out["duplicate_lines"] = _share_repeated(sums, row[new], texts) / lines
    return np.stack([np.asarray(out[name], np.float32) for name in STATS], axis=1)


def statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and ``stats`` (array of float, in the order of ``STATS``) of the column ``text``."""
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def read(batches):
        for batch in batches:
            for lo, hi, s in slabs(batch.column(0)):
                values = stats_of(s)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(i + 1).slice(lo, hi - lo) for i in range(len(kept))), lists], names=[*(f.name for f in kept), "stats"])

    out = frame.mapInArrow(giving_back(read), ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "stats array<float>"]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "stats")


class Trees(NamedTuple):
    """Complete trees of one depth, by level: node k of a level has the children 2k and 2k + 1 of the next."""

    feature: tuple[np.ndarray, ...]  # of each level: (trees, nodes)
    cut: tuple[np.ndarray, ...]  # to the right if the statistic is greater
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray, rows: int = 4096) -> np.ndarray:
        out = np.full(len(x), self.base)
        trees = np.arange(len(self.leaf))[None, :]
        for a in range(0, len(x) if len(self.leaf) else 0, rows):
            part = x[a:a + rows]
            node = np.zeros((len(part), len(self.leaf)), np.int64)
            row = np.arange(len(part))[:, None]
            for feature, cut in zip(self.feature, self.cut):
                node = 2 * node + (part[row, feature[trees, node]] > cut[trees, node])
            out[a:a + rows] += self.leaf[trees, node].sum(1)
        return 1 / (1 + np.exp(-out))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0,
              least: int = 20, features_share: float = 0.3) -> Trees:
    """Boosted trees for the labels ``y`` (0 or 1) by histograms of gradients.

    Each tree sees a share of the statistics, drawn by a fixed seed, so that the score rests on many of them. A side of a
    split has ``least`` rows at least, or a quarter of the rarer label's rows where those are fewer.
    """
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Trees((), (), np.zeros((0, 1)), float(np.log(share / (1 - share))))
    n, features = x.shape
    least = max(1, min(least, int(min(y.sum(), n - y.sum())) // 4))
    draw = np.random.default_rng(1)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(features)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(features)], axis=1)  # bin b: at most cuts[b]
    upper = np.full((features, bins), np.inf, np.float32)
    for f, c in enumerate(cuts):
        upper[f, :len(c)] = c
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    levels: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(depth)]
    leaves = []
    flat = binned + np.arange(features) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        seen = draw.permutation(features)[:max(1, round(features_share * features))]
        hidden = np.delete(np.arange(features), seen)
        for level in range(depth):
            nodes = 1 << level
            at = (node[:, None] * (features * bins) + flat).ravel()
            shape = (nodes, features, bins)
            sums = [np.bincount(at, weights=np.repeat(v, features), minlength=nodes * features * bins).reshape(shape).cumsum(2) for v in (g, h, np.ones(n))]
            gl, hl, nl = sums
            gt, ht, nt = (v[:, :, -1:] for v in sums)
            gain = gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain = np.where((nl >= least) & (nt - nl >= least), gain, 0)
            gain[:, hidden] = 0
            gain = gain.reshape(nodes, -1)
            best = gain.argmax(1)
            feature, b = np.divmod(best, bins)
            b = np.where(gain[np.arange(nodes), best] > 1e-9, b, bins - 1)  # no split: all go left
            levels[level].append((feature, np.where(b == bins - 1, np.inf, upper[feature, b])))
            node = 2 * node + (binned[np.arange(n), feature[node]] > b[node])
        count = 1 << depth
        leaf = -rate * np.bincount(node, weights=g, minlength=count) / (np.bincount(node, weights=h, minlength=count) + l2)
        leaves.append(leaf)
        score += leaf[node]
    return Trees(tuple(np.stack([f for f, _ in lv]) for lv in levels), tuple(np.stack([c for _, c in lv]).astype(np.float32) for lv in levels), np.stack(leaves), base)


def fit(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS, **options) -> Trees:
    """Trees from ``stats`` (doc_id, stats) and ``labels`` (doc_id, quality); at most ``max_rows`` rows are used."""
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id"))
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
    )
    # the rows of the least hashes: first by a threshold that leaves a few more, so that little is ordered
    place = F.abs(F.xxhash64("_id") / 2.0**63)
    own = stats.select(F.col(doc_id).alias("_id"), "stats")
    met = own.select("_id").join(known.select("_id"), "_id").count()  # labels of other documents don't take a share
    share = (max_rows + 6 * max_rows**0.5 + 10) / max(1, met)
    rows = (
        own.join(known.where(place <= share), "_id")
        .orderBy(place, "_id", "stats").limit(max_rows).select("stats", "y").toPandas()
    )
    x = np.stack(rows["stats"]) if len(rows) else np.zeros((0, len(STATS)), np.float32)
    return fit_trees(np.asarray(x, np.float32), rows["y"].to_numpy(np.float64), **options)


def score(stats: DataFrame, trees: Trees, keep: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep``, score and predicted (1 from ``threshold``) of rows with ``stats``."""
    frame = stats.select("stats", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    kept = frame.schema.fields[1:]

    def read(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*(batch.column(i + 1) for i in range(len(kept))), pa.array(trees.score(x))], names=[*(f.name for f in kept), "score"])

    out = frame.mapInArrow(giving_back(read), ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "score double"]))
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_texts(docs: DataFrame, trees: Trees, keep: Sequence[str], threshold: float = THRESHOLD) -> DataFrame:
    """The same for rows with the column ``text``: statistics and score in one step, so that nothing is stored."""
    others = [c for c in keep if c != "text"]
    frame = docs.select("text", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(others)])

    columns = [*frame.columns, "score"]

    def read(batches):
        for batch in batches:
            for lo, hi, s in slabs(batch.column(0)):
                own = [batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(trees.score(stats_of(s)))], names=columns)

    out = frame.mapInArrow(giving_back(read), ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields), "score double"]))
    names = {c: f"_k{i}" for i, c in enumerate(others)} | {"text": "text"}
    return out.select(*[F.col(names[c]).alias(c) for c in keep], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def fit_texts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS) -> Trees:
    """Trees from the labelled rows of ``docs``; only statistics are stored."""
    known = labels.select(F.col(doc_id).alias("_doc"), F.col(label).alias("_label"))
    stats = stage(statistics(docs.select("text", F.col(doc_id).alias("_doc")), ("_doc",)), "stats")
    return fit(stats, known, "_doc", "_label", max_rows)


def classify(docs: DataFrame, labels: DataFrame, learn: Column | None = None, keep: Sequence[str] = ("doc_id",), doc_id: str = "doc_id",
             label: str = "quality", threshold: float = THRESHOLD, max_rows: int = MAX_ROWS) -> DataFrame:
    """Fit on the labelled rows for which ``learn`` holds and score all rows of ``docs``."""
    learn = F.lit(True) if learn is None else learn
    frame = docs.select("text", F.col(doc_id).alias("_doc"), F.coalesce(learn, F.lit(False)).alias("_learn"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)])
    stats = stage(statistics(frame, ("_doc", "_learn", *[f"_c{i}" for i in range(len(keep))])), "stats")
    known = labels.select(F.col(doc_id).alias("_doc"), F.col(label).alias("_label"))
    trees = fit(stats.where("_learn"), known, "_doc", "_label", max_rows)
    out = score(stats, trees, [f"_c{i}" for i in range(len(keep))], threshold)
    return out.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(keep)})
