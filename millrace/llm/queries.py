"""The registered queries of the text operators, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import divergence, filter_audit, hard_negatives, huffman_ids, iblt, language_id, mixing, ngram_lm, packing, quality_classifier, secrets, simhash, suffix_dedup
from millrace.llm.text import small_batches
from millrace.session import Tables

#: A vocabulary file that all nodes have; the operators take its path.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            small_batches(spark)
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def fold(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


@query("op1_quality_classifier")
def op1_quality_classifier(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text").withColumn("held_out", fold(5) == 0)
    return quality_classifier.classify(docs, t.labels, ~F.col("held_out"), ("doc_id", "held_out"))


@query("op2_lm_scoring")
def op2_lm_scoring(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text").withColumn("held_out", fold(5) == 1)
    model = ngram_lm.train(docs.where(~F.col("held_out")))
    return ngram_lm.score(docs, model, ("doc_id", "held_out"))


@query("op3_document_fingerprints")
def op3_document_fingerprints(t: Tables) -> DataFrame:
    return iblt.compare(t.documents, ("doc_id",))


@query("op4_suffix_array_dedup")
def op4_suffix_array_dedup(t: Tables) -> DataFrame:
    found = suffix_dedup.dedup(t.documents, ("doc_id",), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_language_id")
def op5_language_id(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text", "lang").withColumn("held_out", fold(3) == 1)
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs, model, ("doc_id", "held_out"))


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(t: Tables) -> DataFrame:
    return simhash.near_duplicates(t.documents, ("doc_id",), width=4, distance=4).drop("root")


def _divergence_sql() -> str:
    """The rules in SQL; sums over the classes and common words are spelled out as list expressions."""
    words = "[" + ", ".join(f"'{w}'" for w in divergence.COMMON_WORDS) + "]"
    n = len(divergence.COMMON_WORDS) + 1

    def means(column: str, size: int) -> str:
        return "[" + ", ".join(f"avg({column}[{i + 1}])" for i in range(size)) + "]"

    def far(p: str, q: str) -> str:
        part = "case when {0} > 0 then {0} * log2(2 * {0} / ({0} + {1})) else 0 end"
        one, two = part.format("z[1]", "z[2]"), part.format("z[2]", "z[1]")
        return f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: ({one} + {two}) / 2)), 0))"

    def reference(rows: str) -> str:
        return f"select lang, {means('classes', divergence.CLASSES)} as mc, {means('common', n)} as mw from {rows} where kept group by lang"

    def judged(means: str) -> str:
        return f"""
          select s.*, not base_failed and coalesce({far("classes", "mc")}, 0) <= {divergence.CLASS_LIMIT}
                      and coalesce({far("common", "mw")}, 0) <= {divergence.WORD_LIMIT} as kept
          from scaled s left join {means} r on s.lang is not distinct from r.lang"""

    return f"""
with docs as (
  select row_number() over () as id, doc_id, lang, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents
), places as (
  select id, words, unnest(range(1, len(words) - 1)) as i from docs where len(words) > 2
), windows as (
  select id, i, count(*) over (partition by id, words[i], words[i + 1], words[i + 2]) as n from places
), covered as (
  select id, count(distinct place) as n from (select id, unnest([i, i + 1, i + 2]) as place from windows where n > 1) group by id
), counts as (
  select doc_id, lang, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(c.n, 0) as n_repeat_words, length(text) as chars, strlen(text) - length(text) as high,
         len(regexp_extract_all(text, '[A-Z]')) as upper_, len(regexp_extract_all(text, '[0-9]')) as digit,
         len(regexp_extract_all(text, '[.,;:?]')) as stop, len(regexp_extract_all(text, '[!"''()+\\-/=@\\[\\\\\\]^_`{{}}~]')) as mark,
         list_transform({words}, lambda c: len(list_filter(words, lambda w: lower(w) = c))) as common
  from docs left join covered c using (id)
), histograms as (
  select * exclude (common), n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         [greatest(word_chars - upper_ - digit - stop - mark - n_symbols - high, 0), chars - word_chars, upper_, digit, stop, mark, n_symbols, high] as classes,
         list_append(common, n_words - list_sum(common)::bigint) as common
  from counts
), scaled as (
  select * exclude (classes, common),
         case when chars >= {divergence.MIN_CHARS} then list_transform(classes, lambda x: x / list_sum(classes)) end as classes,
         case when n_words >= {divergence.LEAST_COMMON} then list_transform(common, lambda x: x / list_sum(common)) end as common
  from histograms
), means1 as ({reference("(select *, not base_failed as kept from scaled)")}),
round1 as ({judged("means1")}),
means2 as ({reference("round1")}),
round2 as ({judged("means2")})
select doc_id, n_words::bigint as n_words, word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
       n_repeat_words::bigint as n_repeat_words, base_failed, kept
from round2
"""


@query("op7_quality_rules", _divergence_sql())
def op7_quality_rules(t: Tables) -> DataFrame:
    return divergence.judge(t.documents, ("doc_id",)).drop("class_distance", "word_distance")


@query("op8_mixing", """
with recursive sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5) / 4503599627370496.0 as u
  from documents
), weighed as (
  select *, log2(1 + size) as pref from sized
), sources as (
  select source, sum(size)::bigint as words, sum(size * pref) as wp,
         (array[5.0, 2.0, 1.0])[(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as weight
  from weighed group by source
), levels as (
  select 0 as n, 0::double as level
  union all
  select n + 1, ((select sum(words) from sources) - coalesce((select sum(3 * words) from sources where weight * level > 3.0 * words), 0))::double
                / (select sum(weight) from sources where weight * level <= 3.0 * words)
  from levels where n < 40
), shares as (
  select source, words, wp, least(3.0 * words, weight * (select level from levels order by n desc limit 1))::double as target from sources
), parts as (
  select *, case when words > 0 then floor(target / words)::bigint else 0 end as whole from shares
), ranked as (
  select doc_id, w.source, size, words, target, whole, target - whole * words as rest,
         u / (1 - u) * ((1 - c) / c) as rank
  from (select w.*, p.* exclude (source),
               greatest(1e-6, least(1 - 1e-6, (target - whole * words) / words * pref * words / wp)) as c
        from weighed w join parts p on w.source is not distinct from p.source) w
), running as (
  select *, sum(size) over (partition by source order by rank, doc_id, size rows unbounded preceding) <= rest as fits,
         row_number() over (partition by source order by rank, doc_id, size) as rn
  from ranked where size > 0
), waiting as (
  select *, rn - sum(fits::int) over (partition by source) as nth from running
), fill as (
  select source, 0::bigint as nth, (any_value(rest) - coalesce(sum(size) filter (fits), 0))::double as remaining, false as taken
  from waiting group by source
  union all
  select w.source, w.nth, case when w.size <= f.remaining then f.remaining - w.size else f.remaining end, w.size <= f.remaining
  from fill f join waiting w on w.source is not distinct from f.source and w.nth = f.nth + 1
), copies as (
  select w.doc_id, w.source, size, words, target, whole + (fits or coalesce(f.taken, false))::int as copies
  from waiting w left join fill f on f.source is not distinct from w.source and f.nth = w.nth and w.nth > 0
  union all
  select doc_id, source, size, words, target, whole from ranked where size = 0
)
select doc_id, size::bigint as size, words as source_size, target, copies::bigint as copies, (size * copies)::bigint as taken from copies
""")
def op8_mixing(t: Tables) -> DataFrame:
    # long documents are preferred a little
    return mixing.mix(t.documents, ("doc_id",), preference=F.log2(1 + mixing.n_words()))


@query("op9_token_output")
def op9_token_output(t: Tables) -> DataFrame:
    folder = huffman_ids.write_files(t.documents, WORD_BPE, "doc_id", end=2)
    texts = huffman_ids.read_files(t.spark, folder)
    return texts.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_packing")
def op10_packing(t: Tables) -> DataFrame:
    pieces = packing.pack(t.documents, WORD_BPE, ("doc_id",), end=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op11_filter_audit", r"""
with flags as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), firsts as (
  select text, min(doc_id) as first from flags group by text
), known as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id
), docs as (
  select part, coalesce(good, false) as good, coalesce(k.toxic, false) as toxic,
         {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
          'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc_id > first, false)} as f
  from flags d join firsts using (text) left join known k using (doc_id)
), letters as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x
), orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), failed as (
  select part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'],
         lambda x: case x when 'A' then f.A when 'B' then f.B when 'C' then f.C when 'D' then f.D else f.E end) as fails from docs
), kinds as (
  select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failed group by all
), steps as (
  select part, filter_order, step, filter_order[step] as x, fails, n, good, toxic,
         list_has_any(fails, string_split(filter_order[1:step - 1], '')) as gone, list_contains(fails, filter_order[step]) as hit
  from kinds, orders, range(1, 6) s(step)
), tallied as (
  select part, filter_order, step, x, coalesce(sum(n) filter (not gone and not hit), 0) as kept,
         coalesce(sum(n) filter (not gone and hit), 0) as removed, coalesce(sum(n) filter (gone and hit), 0) as redundant,
         coalesce(sum(n) filter (hit and len(fails) = 1), 0) as unique_fails,
         coalesce(sum(good) filter (not gone and hit), 0) as good_lost, coalesce(sum(toxic) filter (not gone and hit), 0) as toxic_lost
  from steps group by all
)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, x))::bigint as shapley
from tallied
""")
def op11_filter_audit(t: Tables) -> DataFrame:
    return filter_audit.audit(t.documents, t.labels)


@query("op12_secret_scan")
def op12_secret_scan(t: Tables) -> DataFrame:
    return secrets.digest(t.documents, ("doc_id",))


@query("op13_hard_negatives", """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_inner_product(a.q, r.q)::bigint as score
  from rows a join rows r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
""")
def op13_hard_negatives(t: Tables) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.prepare(t.embeddings, label=label), F.col("vec_id") % 100 == 0)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
