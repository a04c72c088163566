import re
from collections import Counter

from pyspark.sql import functions as F

from millrace.operators import mentions, sketches
from tests.conftest import plan, rows


def test_merged_distinct_sketches_stay_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("day"), (F.col("id") % 20_011).alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 0, None), (None, 1, 5)], "k long, day long, v long"))
    fine = sketches.distinct_sketches(df, ["k", "day"], "v")
    merged = sketches.merge_distinct(fine, ["k"]).select("k", F.hll_sketch_estimate("sketch").alias("n"))
    exact = {r[0]: r[1] for r in df.groupBy("k").agg(F.countDistinct("v")).collect()}
    for k, n in merged.collect():
        assert abs(n - exact[k]) <= max(1, exact[k] * sketches.distinct_error()), k
    assert rows(merged) == rows(merged)


def test_merged_quantiles_are_near_their_rank_and_bounded(spark):
    df = spark.range(80_000).select((F.col("id") % 2).alias("k"), (F.col("id") % 11).alias("part"), F.pow(F.col("id") % 1009, 2).alias("v"))
    odd = spark.createDataFrame([(5, 0, float("nan")), (5, 1, None), (6, 0, 2.5)], "k long, part long, v double")
    fine = sketches.quantile_sketches(df.unionByName(odd), ["k", "part"], "v")
    merged = sketches.merge_quantiles(fine, ["k"])
    assert merged.agg(F.max(F.length("sketch"))).first()[0] < 20_000
    marks = merged.select("k", F.lit(0.9).alias("prob"), sketches.quantile("sketch", 0.9).alias("mark"))
    found = {r["k"]: r for r in sketches.true_ranks(df, ["k"], "v", marks, "mark").collect()}
    assert set(found) == {0, 1}
    for r in found.values():
        assert r["below"] <= 0.9 + sketches.rank_error() and r["upto"] >= 0.9 - sketches.rank_error()
    assert {r["k"]: r["mark"] for r in marks.where("k > 1").collect()} == {5: None, 6: 2.5}
    bounds = sketches.sketched_iqr_bounds(merged.where("k = 6")).first()
    assert (bounds["q1"], bounds["lower"], bounds["upper"]) == (2.5, 2.5, 2.5)


TEXTS = [(1, "The river runs, the river stays."), (2, None), (3, ""), (4, "bora bora is far"), (5, "New\nYork, new york"), (6, "newyork river-bank"),
         (7, "bora"), (8, "çà et là: État_1"), (9, "york new"), (None, "the river")]
WORDS = ["River", "river", "the river", "New York", "bora bora", "bora", "état_1", "et là", "absent", "river absent", "", "--", None, "river-bank", "is far away"]


def test_keyword_table_equals_brute_force(spark):
    found = mentions.keyword_mentions(spark.createDataFrame(TEXTS, "id long, text string"), "id", "text",
                                      spark.createDataFrame([(w,) for w in WORDS + ["bora"]], "word string"), "word")

    def split(text):
        return [w for w in re.split(r"\W+", (text or "").lower()) if w]

    want = Counter({w: 0 for w in WORDS})
    for w in WORDS:
        words = split(w)
        for _, text in TEXTS:
            body = split(text)
            want[w] += bool(words) and any(body[i:i + len(words)] == words for i in range(len(body)))
    got = found.collect()
    assert {r[0]: r[1] for r in got} == dict(want) and len(got) == len(want)


def test_ten_thousand_keywords_need_no_pattern_each(spark):
    words = spark.range(10_000).select(F.concat(F.lit("w"), "id", F.when(F.col("id") % 2 == 0, F.lit(" tail")).otherwise(F.lit(""))).alias("word"))
    docs = spark.range(300).select("id", F.concat(F.lit("w"), "id", F.lit(", tail w"), F.col("id") + 1).alias("text"))
    found = mentions.keyword_mentions(docs, "id", "text", words, "word")
    text = plan(found)
    assert "RLike" not in text and "CartesianProduct" not in text and "NestedLoop" not in text and len(text) < 60_000
    # "w<even> tail" in its own document only; an odd word in its own and the one before
    assert found.where("documents > 0").groupBy("documents").count().orderBy("documents").collect() == [(1, 150), (2, 150)]


def test_phrases_of_two_words_are_counted_without_a_search(spark):
    """Every document holds every word, so that a search by the rarest word would try all phrases in all of them."""
    names = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(names[i:] + names[:i])) for i in range(40)], "id long, text string")
    words = spark.createDataFrame([(f"{a}, {b}",) for a in names for b in names] + [(f"{names[0]} w1 w2 w3",), ("w39 w0 w2",)], "word string")
    found = mentions.keyword_mentions(docs, "id", "text", words.where("word LIKE '%,%'"), "word")
    assert "contains" not in plan(found).lower() and "collect_list" not in plan(found)
    next_to = {(a, b) for a, b in zip(names, names[1:] + names[:1])}
    assert {tuple(r[0].split(", ")): r[1] for r in found.collect()} == {(a, b): 39 * ((a, b) in next_to) for a in names for b in names}
    both = {r[0]: r[1] for r in mentions.keyword_mentions(docs, "id", "text", words, "word").where("documents > 0").collect()}
    assert both["w0 w1 w2 w3"] == 37 and both["w0, w1"] == 39 and "w39 w0 w2" not in both and len(both) == 41
