"""Mentions of a table of keywords in texts (A19 for many keywords)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import checked_broadcast
from millrace.session import stage

#: Words are runs of letters, digits and underscores.
BETWEEN = r"[^\p{L}\p{N}_]+"


def words_of(text: str | Column) -> Column:
    """The lower-cased words of a text in order; none for NULL."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN), lambda w: w != "")


def pairs_of(w: Column) -> Column:
    """The adjacent words of a list, two by two, joined by a space."""
    return F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, 2, F.size(w)), lambda x, y: F.concat(x, F.lit(" "), y))


def _units(text: str, body: Callable[[Column], Column]) -> Column:
    """One row per different value that ``body`` makes of the words of a text, which are split once; NULL if there is none."""
    # an outer explode, since Spark would compute the list of an inner one a second time to filter out empty ones
    return F.explode_outer(F.array_distinct(F.flatten(F.transform(F.array(words_of(text)), body)))).alias("unit")


def keyword_mentions(docs: DataFrame, doc_id: str, text: str, keywords: DataFrame, keyword: str) -> DataFrame:
    """(keyword, documents): how many documents mention each keyword as whole words, in any case; 0 where none does.

    A keyword is a word or a sequence of words, whatever stands between them. Keywords that differ only in case or in what
    stands between their words count alike; keywords without a word, and NULL, get 0. ``doc_id`` names each document once.

    No pattern is tried per keyword. Each text is exploded once into its different words and pairs of adjacent words; those of a
    keyword are counted, combined before the shuffle, and answer keywords of one and two words. A longer phrase is looked for only in documents that hold its rarest
    pair: the phrases of one document are gathered, the text comes to them once, and a substring test on its words decides. As a phrase's
    rarest pair, a frequent one is spread over tasks by the documents that hold it, as adaptive execution splits a large partition of the join.
    """
    wanted = stage(keywords.select(F.col(keyword).alias("keyword"), words_of(keyword).alias("_words")).distinct()
                   .withColumn("_phrase", F.concat(F.lit(" "), F.array_join("_words", " "), F.lit(" "))), "keywords")
    phrases = wanted.where(F.size("_words") > 0).select("_phrase", "_words").distinct()
    units = F.when(F.size("_words") == 1, F.col("_words")).otherwise(pairs_of(F.col("_words")))
    parts = phrases.select("_phrase", F.size("_words").alias("_len"), F.explode(F.array_distinct(units)).alias("unit"))
    # Most pairs of a text are no keyword's: they go before they are counted.
    asked = checked_broadcast(stage(parts.select("unit").distinct(), "asked"))
    # A phrase with a unit that no document holds has no row here for it and counts 0 below.
    counts = docs.select(_units(text, lambda w: F.concat(w, pairs_of(w)))).join(asked, "unit", "left_semi").groupBy("unit").agg(F.count(F.lit(1)).alias("_n"))
    found = stage(parts.join(counts, "unit", "left").withColumn("_n", F.coalesce("_n", F.lit(0))), "units")
    single = found.where("_len <= 2").select("_phrase", F.col("_n").alias("documents"))
    longer = found.where("_len > 2")
    if longer.isEmpty():
        return wanted.join(single, "_phrase", "left").select("keyword", F.coalesce("documents", F.lit(0)).alias("documents"))

    order = Window.partitionBy("_phrase").orderBy("_n", "unit")
    anchors = longer.withColumn("_nth", F.row_number().over(order)).where("_nth = 1 AND _n > 0").select("unit", "_phrase")
    held = docs.select(F.col(doc_id).alias("_doc"), _units(text, pairs_of))
    tried = held.join(anchors, "unit").groupBy("_doc").agg(F.collect_list("_phrase").alias("_tried"))
    body = docs.select(F.col(doc_id).alias("_id"), F.concat(F.lit(" "), F.array_join(words_of(text), " "), F.lit(" ")).alias("_body"))
    met = tried.join(body, F.col("_doc").eqNullSafe(F.col("_id")))
    hits = met.select(F.explode(F.expr("filter(_tried, p -> contains(_body, p))")).alias("_phrase"))
    several = hits.groupBy("_phrase").agg(F.count(F.lit(1)).alias("documents"))
    total = single.unionByName(several)
    return wanted.join(total, "_phrase", "left").select("keyword", F.coalesce("documents", F.lit(0)).alias("documents"))
