"""Hard-negative mining: rows of another label that score just below an anchor's positives.

Scores are integer inner products of floor(256 * x). Anchors are dealt to slabs of near ones. Each slab gets a minimum
spanning tree over its anchors' Euclidean distances. For a candidate ``c``, an anchor ``a`` and its parent ``p`` in the tree

    |<a, c> - <p, c>| <= |a - p| * |c|

so an interval known at the parent bounds the child's score; from a root whose scores are computed the intervals go
down the tree level by level. Only candidates whose interval overlaps the anchor's window are scored again, which makes
their interval a point for the anchors below. The window is what still can enter a result: for positives all scores from
the worst of the best found so far; for negatives from the least to the greatest score that a positive of the anchor
allows, raised as results fill up. All comparisons that decide are on exact scores.

Work is dealt by (slab, part of the rows): both are bounded, both sides are shuffled by that pair, and every task hands out
at most the wanted number of rows for each anchor (and positive), of which a window keeps the best. No label or
vector is a key, so hot labels and copies are spread.

Defined results: rows without an id, label, vector, or with a null or non-finite component take no part, nor do rows of
squared norm 2^63 or more, whose own score does not fit in a long. Rows equal in id, label and vector count once; other rows
of equal id are rows of their own, and as anchors of equal id have a list each. A shorter vector is filled with
zeros. Ties go by smaller id, then by label and vector. Empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage

SLAB = 1024
PART = 50_000
#: Anchors are ordered by their sides of so many planes before they are cut into slabs.
PLANES = 12
#: Candidates that go down the tree at a time.
CHUNK = 512
#: Scores above this many of a level are computed as one product.
DENSE = 0.05
EXACT = 2.0**53
NEG = np.iinfo(np.int64).min


def prepare(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label") -> DataFrame:
    """vec_id, label, q (integers) of the rows that take part, with a ``row`` number that tells equal ids apart."""
    whole = F.transform(F.col(vector), lambda x: F.floor(256 * x.cast("double")))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    norm = F.aggregate("q", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows = rows.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), whole.alias("q"))
    rows = rows.where(F.col("label").isNotNull()).where(norm < 2.0**63).dropDuplicates()
    return rows.withColumn("tie", F.xxhash64("label", "q"))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, not below the true ones by more than the slack that ``bounds`` adds."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, level) of a minimum spanning tree rooted at row 0; the root is its own parent."""
    n = len(vectors)
    parent, level = np.zeros(n, np.int64), np.zeros(n, np.int64)
    away = distances(vectors, vectors[:1])[:, 0]
    away[0] = np.inf
    open_ = np.ones(n, bool)
    open_[0] = False
    for _ in range(n - 1):
        at = int(np.argmin(np.where(open_, away, np.inf)))
        if not open_[at]:  # only infinite distances are left
            at = int(np.flatnonzero(open_)[0])
        open_[at] = False
        level[at] = level[parent[at]] + 1
        d = distances(vectors, vectors[at:at + 1])[:, 0]
        nearer = open_ & (d < away)
        away[nearer], parent[nearer] = d[nearer], at
    return parent, level


def matrix(column: pa.ChunkedArray | pa.Array, dims: int | None = None) -> np.ndarray:
    """A list column as rows of equal length, filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dims = max(int(sizes.max(initial=0)), 1) if dims is None else dims
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Tree:
    """The anchors of a slab in the order of their levels, with exact scores and bounds by the tree."""

    def __init__(self, vectors: np.ndarray):
        self.q = vectors
        self.f = vectors.astype(float)
        self.parent, level = spanning_tree(self.f)
        edge = np.linalg.norm(self.f - self.f[self.parent], axis=1)
        self.edge = edge * (1 + 1e-9)
        self.levels = [np.flatnonzero(level == i) for i in range(int(level.max(initial=0)) + 1)]
        self.norm = math.sqrt(float((self.f * self.f).sum(1).max(initial=0)))

    def scored(self, candidates: np.ndarray, low, high, wanted):
        """Exact scores (anchors x candidates) where the bounds overlap [low, high] of the anchor and ``wanted`` holds, and where they are.

        ``low`` and ``high`` are by anchor, ``wanted`` is anchors x candidates.
        """
        c = candidates.astype(float)
        norms = np.sqrt((c * c).sum(1)) * (1 + 1e-9)
        exact = self.norm * norms.max(initial=0) < EXACT  # then sums of products are whole numbers in a double, in any order
        score = np.zeros((len(self.q), len(c)), np.int64)
        known = np.zeros(score.shape, bool)
        lo, hi = np.empty(score.shape), np.empty(score.shape)

        def compute(rows):
            return np.rint(self.f[rows] @ c.T).astype(np.int64) if exact else self.q[rows] @ candidates.T

        for depth, rows in enumerate(self.levels):
            if depth == 0:
                again = np.ones((len(rows), len(c)), bool)
            else:
                up, reach = self.parent[rows], self.edge[rows][:, None] * norms[None, :]
                slack = 1e-9 * (np.abs(lo[up]) + np.abs(hi[up])) + 1
                lo[rows], hi[rows] = lo[up] - reach - slack, hi[up] + reach + slack
                again = wanted[rows] & (hi[rows] >= low[rows][:, None]) & (lo[rows] <= high[rows][:, None])
            part = again.mean() if again.size else 0
            if part > DENSE:
                full = compute(rows)
                score[rows] = np.where(again, full, 0)
            elif part:
                r, k = np.nonzero(again)
                score[rows[r], k] = np.einsum("ij,ij->i", self.q[rows[r]], candidates[k])
            known[rows] = again
            exactly = score[rows].astype(float)
            lo[rows], hi[rows] = np.where(again, exactly, lo[rows]), np.where(again, exactly, hi[rows])
        return score, known & wanted


def best(score: np.ndarray, vec_id: np.ndarray, tie: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` by score (falling), id and tie."""
    if len(score) > n:
        cut = np.partition(score, len(score) - n)[len(score) - n]
        places = np.flatnonzero(score >= cut)
    else:
        places = np.arange(len(score))
    return places[np.lexsort((tie[places], vec_id[places], -score[places]))[:n]]


class Top:
    """The first ``n`` of one list so far."""

    def __init__(self, n: int):
        self.n, self.rows = n, np.zeros((3, 0), np.int64)

    def add(self, score, vec_id, tie):
        rows = np.hstack([self.rows, np.stack([score, vec_id, tie])])
        self.rows = rows[:, best(*rows, self.n)]

    @property
    def least(self) -> int:
        """What a row must score at least to enter."""
        return int(self.rows[0, -1]) if self.rows.shape[1] == self.n else NEG


def _columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy().astype(np.int64) for n in names]


def _sides(anchors: pa.Table, rows: pa.Table):
    dims = max(1, *(pc.max(pc.list_value_length(t.column("q"))).as_py() for t in (anchors, rows)))
    return Tree(matrix(anchors.column("q"), dims)), matrix(rows.column("q"), dims)


def _positives(wanted: int):
    def run(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        lists = [Top(wanted) for _ in range(anchors.num_rows)]
        if anchors.num_rows and rows.num_rows:
            tree, q = _sides(anchors, rows)
            a_id, a_label, a_tie = _columns(anchors, "vec_id", "label", "tie")
            c_id, c_label, c_tie = _columns(rows, "vec_id", "label", "tie")
            high = np.full(len(lists), np.inf)
            for at in range(0, len(q), CHUNK):
                own = slice(at, at + CHUNK)
                same = (a_label[:, None] == c_label[None, own]) & ~((a_id[:, None] == c_id[None, own]) & (a_tie[:, None] == c_tie[None, own]))
                least = np.array([x.least for x in lists])
                score, known = tree.scored(q[own], least, high, same)
                known &= score >= least[:, None]
                for i in np.flatnonzero(known.any(1)):
                    k = np.flatnonzero(known[i])
                    lists[i].add(score[i, k], c_id[own][k], c_tie[own][k])
        return _listed(anchors, [(i, None, x) for i, x in enumerate(lists)])

    return run


def _negatives(wanted: int, least: tuple[int, int], most: tuple[int, int]):
    def run(key, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        positives = anchors.column("positives").to_pylist()
        lists = [(i, p, Top(wanted)) for i, own in enumerate(positives) for p in own]
        if lists and rows.num_rows:
            tree, q = _sides(anchors, rows)
            (a_label,), (c_id, c_label, c_tie) = _columns(anchors, "label"), _columns(rows, "vec_id", "label", "tie")
            floor = [-(-p["score"] * least[0] // least[1]) for _, p, _ in lists]
            top = [p["score"] * most[0] // most[1] for _, p, _ in lists]
            for at in range(0, len(q), CHUNK):
                own = slice(at, at + CHUNK)
                low, high = np.full(len(positives), np.inf), np.full(len(positives), -np.inf)
                for (i, _, found), a, b in zip(lists, floor, top):
                    if a <= b:
                        low[i], high[i] = min(low[i], max(a, found.least)), max(high[i], b)
                score, known = tree.scored(q[own], low, high, a_label[:, None] != c_label[None, own])
                hit = known.any(1)
                for (i, _, found), a, b in zip(lists, floor, top):
                    if hit[i]:
                        k = np.flatnonzero(known[i] & (score[i] >= max(a, found.least)) & (score[i] <= b))
                        if len(k):
                            found.add(score[i, k], c_id[own][k], c_tie[own][k])
        return _listed(anchors, lists)

    return run


#: anchor (its place in the staged table), the positive's id, tie and score where there is one, and the found row
FOUND = pa.schema([(n, pa.int64()) for n in ("anchor_id", "anchor_tie", "positive_id", "positive_tie", "positive_score", "vec_id", "tie", "score")])
FOUND_SQL = ", ".join(f"{n} long" for n in FOUND.names)


def _listed(anchors: pa.Table, lists) -> pa.Table:
    a_id, a_tie = _columns(anchors, "vec_id", "tie")
    out: list[list] = [[] for _ in FOUND.names]
    for i, p, found in lists:
        for score, vec_id, tie in found.rows.T.tolist():
            for column, value in zip(out, (a_id[i], a_tie[i], p and p["vec_id"], p and p["tie"], p and p["score"], vec_id, tie, score)):
                column.append(value)
    return pa.table([pa.array(c, pa.int64()) for c in out], schema=FOUND)


def _first(found: DataFrame, by: list[str], n: int) -> DataFrame:
    """The first ``n`` of each list, numbered."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "tie")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def slabs(anchors: DataFrame, size: int = SLAB) -> DataFrame:
    """Anchors with a slab number; those on the same sides of a few planes come to the same slabs."""
    n = math.ceil(anchors.count() / size)
    if n <= 1:
        return anchors.withColumn("slab", F.lit(0).cast("long"))

    def side(i: int) -> Column:  # a plane with random signs as its normal
        signed = F.transform("q", lambda x, j: F.when(F.xxhash64(j, F.lit(i)) > 0, x).otherwise(-x).cast("double"))
        return F.when(F.aggregate(signed, F.lit(0.0), lambda total, x: total + x) > 0, 1 << i).otherwise(0)

    code = sum((side(i) for i in range(PLANES)), F.lit(0))
    cut = stage(anchors.withColumn("_code", code).repartitionByRange(n, "_code", "vec_id", "tie").withColumn("_range", F.spark_partition_id()), "anchors")
    # ranges are about even; a larger one makes more slabs
    nth = F.row_number().over(Window.partitionBy("_range").orderBy("_code", "vec_id", "tie")) - 1
    return cut.withColumn("slab", F.floor(nth / size) * n + F.col("_range")).drop("_range", "_code")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: tuple[int, int] = (30, 100),
         most: tuple[int, int] = (90, 100), part_rows: int = PART, slab_rows: int = SLAB) -> DataFrame:
    """Per anchor and positive, the first rows of another label that score from ``least`` to ``most`` of the positive.

    ``rows`` are as ``prepare`` gives them; ``positives`` and ``negatives`` say how many of each.
    """
    rows = stage(rows, "vectors")
    parts = max(math.ceil(rows.count() / part_rows), 1)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "tie"), F.lit(parts)))
    anchors = stage(slabs(rows.where(is_anchor).drop("part"), slab_rows), "slabs")
    last = anchors.agg(F.coalesce(F.max("slab"), F.lit(-1))).first()[0]
    if last < 0:
        last = 0  # no anchors: the plan stays, and finds nothing
    each = rows.withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))).groupBy("slab", "part")

    def search(anchors: DataFrame, run) -> DataFrame:
        everywhere = anchors.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        return everywhere.groupBy("slab", "part").cogroup(each).applyInArrow(run, FOUND_SQL)

    first = _first(search(anchors, _positives(positives)), ["anchor_id", "anchor_tie"], positives)
    found = F.struct("rank", "vec_id", "tie", "score")
    lists = first.groupBy("anchor_id", "anchor_tie").agg(F.sort_array(F.collect_list(found)).alias("positives"))
    lists = lists.withColumnsRenamed({"anchor_id": "vec_id", "anchor_tie": "tie"})
    anchors = stage(anchors.join(lists, ["vec_id", "tie"]), "positives")
    key = ["anchor_id", "anchor_tie", "positive_id", "positive_tie"]
    return _first(search(anchors, _negatives(negatives, least, most)), key, negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
