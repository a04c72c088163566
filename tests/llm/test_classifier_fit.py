"""What the classifier learns from: the label bound, and trees against a slow search and walk."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import quality_classifier as qc


@pytest.mark.parametrize("bound", [30, 300, 1000])
def test_labels_of_other_documents_take_no_share_of_the_bound(spark, monkeypatch, bound):
    width = len(qc.STATS)
    stats = spark.range(400).select(F.col("id").alias("doc_id"), F.array(*[(F.col("id") * (i + 1) % 7).cast("float") for i in range(width)]).alias("stats"))
    labels = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    seen = []
    monkeypatch.setattr(qc, "fit_trees", lambda x, y, **_: seen.append((len(x), y.mean())))
    qc.fit(stats, labels, max_rows=bound)
    assert seen[0][0] == min(bound, 400) and 0.2 < seen[0][1] < 0.8


def walk(trees, row):
    """One row down every tree, one comparison at a time."""
    total = trees.base
    for t in range(len(trees.leaf)):
        node = 0
        for feature, cut in zip(trees.feature, trees.cut):
            node = 2 * node + int(row[feature[t][node]] > cut[t][node])
        total += trees.leaf[t][node]
    return 1 / (1 + np.exp(-total))


def best_split(x, y, least, l2=1.0):
    """The gain of the best first split, by trying every value of every statistic."""
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))

    def part(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + l2)

    gains = [part(x[:, f] <= v) + part(x[:, f] > v) - part(np.ones(len(y), bool))
             for f in range(x.shape[1]) for v in np.unique(x[:, f]) if least <= (x[:, f] <= v).sum() <= len(y) - least]
    return max(gains), part


def test_first_split_is_the_best_and_the_walk_agrees():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (300, 6)).astype(np.float32)  # fewer values than bins: histograms lose nothing
    y = (x[:, 4] + rng.normal(size=300) > 9).astype(float)
    trees = qc.fit_trees(x, y, features_share=1.0)
    got = trees.score(x)
    assert np.allclose(got, [walk(trees, row) for row in x], atol=1e-6)
    assert ((got >= 0.5) == (y == 1)).mean() > 0.9
    gain, part = best_split(x, y, 20)
    feature, cut = int(trees.feature[0][0][0]), trees.cut[0][0][0]
    left = x[:, feature] <= cut
    assert np.isclose(part(left) + part(~left) - part(np.ones(300, bool)), gain)
