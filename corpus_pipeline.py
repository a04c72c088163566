"""A corpus job in five stages: each works on all that its predecessor kept, and its decisions take effect.

All stages but the last return the columns of ``documents`` (doc_id, text, lang, source, n_chars). Rows without id
or text are kept unless a rule speaks against them; see the operators for their treatment.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import mixing, packing, quality_classifier, shingles, suffix_dedup
from millrace.llm.text import small_batches
from millrace.session import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from all labelled ones, does not reject."""
    small_batches(spark)
    trees = quality_classifier.fit_texts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.score_texts(docs.select(*COLUMNS), trees, COLUMNS).where("predicted = 1").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity of their five-word shingles 0.8 or more; SimHash proposes, the shingles decide): the one of the least id (null last; of equal ids, the least hash
    of id and text). Of rows equal in id and text one stays."""
    small_batches(spark)
    rows = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("_key"))
    groups = shingles.near_duplicates(rows, ("doc_id", "_key"))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("_f")
    # by set of shingles first, so that a large group is small before its rows meet
    first = groups.groupBy("node", "root").agg(least).groupBy("root").agg(F.min("_f").alias("_f"))
    kept = rows.join(stage(first.select(F.col("_f._key").alias("_key")), "first"), "_key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy("source", "lang", "n_chars"))
    return kept.withColumn("_nth", nth).where("_nth = 1").select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier; a character of which only a part is left goes too."""
    small_batches(spark)
    frame = docs.select(*COLUMNS, F.col("text").isNull().alias("_null"))
    rest = suffix_dedup.dedup(frame, ("doc_id", "lang", "source", "n_chars", "_null"), as_text=True)
    changed = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return rest.select("doc_id", F.when(~F.col("_null"), F.col("kept")).alias("text"), "lang", "source", changed.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes."""
    mixed = mixing.mix(docs, COLUMNS, preference=F.log2(1 + mixing.n_words()))
    return mixed.where("copies > 0").select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training windows, with the checksum of their ids."""
    small_batches(spark)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), ("doc_id",))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup by five-word shingles", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: Trees, similarities and suffixes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir.rstrip("/")), name.replace(" ", "-"))
    return stage(STAGES[-1][1](spark, docs, sf_dir.rstrip("/")), "windows")
