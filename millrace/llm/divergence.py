"""Quality rules by distribution divergence.

A text's histogram of character classes, and its histogram of common words, are compared with the mean histogram of
its language by Jensen-Shannon distance (base 2: 0 for equal, 1 for disjoint ones). A text whose distance exceeds the
limit is rejected. Short texts are guarded: a histogram counts only from ``min_chars`` characters or ``least_common``
words on. Everything is a DataFrame expression; the only shuffles are sums by language. The language's means come from all its
texts that pass the base rules, and once more from those of them that are within the limits of the first means.

Base rules come first: fewer than 50 words, or over half of the words in 3-word windows that occur twice.

The language is the column ``lang``; null is a language of its own. Null texts count as empty and fail the base rules.
A language none of whose texts pass the guards has no reference, and its texts are judged by the base rules alone.
Rows with equal or null ids are judged like all others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MIN_CHARS = 200
CLASSES = 8
CLASS_LIMIT = 0.2
LEAST_COMMON = 100
WORD_LIMIT = 0.3
ROUNDS = 2

# Frequent function words of English, German, Spanish and French.
COMMON_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from "
    "der die und den von zu das mit sich für des im auf ist nicht dem eine ein als "
    "de la que el en y los se del las un por con no una para su es al lo "
    "le et les du est pour qui dans par sur au pas avec"
).split()

WHITE = "\t\n\x0b\f\r"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, WHITE, "     "), " "), "")


def repeated_words(words: Column) -> Column:
    """How many words are in 3-word windows that occur at least twice."""

    def covered(at: Column) -> Column:
        # ascending window starts: each adds the words that the one before doesn't cover
        steps = F.zip_with(F.slice(at, 2, F.size(at)), F.slice(at, 1, F.size(at) - 1), lambda x, y: F.least(x - y, F.lit(3)))
        return F.aggregate(steps, F.lit(3), lambda a, x: a + x)

    def by_hash(order: Column) -> Column:
        last = F.size(order) - 1
        twice = F.filter(order, lambda e, k: ((k > 0) & (F.get(order, k - 1)["h"] == e["h"])) | ((k < last) & (F.get(order, k + 1)["h"] == e["h"])))
        return let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    def of_windows(h: Column) -> Column:
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(order, by_hash))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(windows, of_windows))


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",), lang: str = "lang") -> DataFrame:
    """Columns ``keep``, _lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _chars and the histograms
    _classes and _common (counts)."""
    # the text and its words are used more than once below, so they are computed once, in a projection of their own
    frame = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.col(lang).alias("_lang"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])

    def of_words(words: Column) -> Column:
        common = F.filter(words, lambda w: F.lower(w).isin(COMMON_WORDS))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            let(F.transform(common, lambda w: F.lower(w)), lambda own: F.transform(
                F.array(*[F.lit(w) for w in COMMON_WORDS]), lambda w: (F.size(own) - F.size(F.array_remove(own, w))).cast("long"))).alias("common"),
        )

    text = F.col("_text")
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    frame = frame.select(
        *[F.col(f"_k{i}") for i in range(len(keep))], "_lang", let(words_of(text), of_words).alias("_w"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length(text).cast("long").alias("_chars"), count(r"[#*$%&|<>]").alias("n_symbols"),
        count("[A-Z]").alias("_upper"), count("[0-9]").alias("_digit"), count(r"[.,;:?]").alias("_stop"),
        count(r"""[!"'()+\-/=@\[\\\]^_`{}~]""").alias("_mark"), (F.octet_length(text) - F.length(text)).cast("long").alias("_high"),
    )
    frame = stage(frame, "measures").select("*", "_w.*").drop("_w")
    space = F.col("_chars") - F.col("word_chars")
    named = [F.col(c) for c in ("_upper", "_digit", "_stop", "_mark", "n_symbols", "_high")]
    rest = F.greatest(F.col("word_chars") - sum(named[1:], named[0]), F.lit(0))
    other = F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x)
    return frame.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "_lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_chars",
                        F.array(rest, space, *named).alias("_classes"), F.concat("common", F.array(other)).alias("_common"))


def shares(counts: Column) -> Column:
    return let(F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x), lambda n: F.transform(counts, lambda x: x / n))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    each = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))


def judge(docs: DataFrame, keep: Sequence[str] = ("doc_id",), lang: str = "lang", min_words: int = MIN_WORDS, max_repeated: float = MAX_REPEATED,
          min_chars: int = MIN_CHARS, class_limit: float = CLASS_LIMIT, least_common: int = LEAST_COMMON, word_limit: float = WORD_LIMIT,
          rounds: int = ROUNDS) -> DataFrame:
    """Columns ``keep``, the base counts, base_failed, class_distance, word_distance (null where guarded) and kept."""
    rows = measures(docs, [*keep], lang)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumns({
        "_classes": F.when(F.col("_chars") >= min_chars, shares(F.col("_classes"))),
        "_common": F.when(F.col("n_words") >= least_common, shares(F.col("_common"))),
    })
    judged = rows.withColumn("kept", ~F.col("base_failed"))
    for _ in range(rounds):
        of = [F.array(*[F.avg(F.get(c, F.lit(i))) for i in range(size)]).alias(f"_mean{c}") for c, size in (("_classes", CLASSES), ("_common", len(COMMON_WORDS) + 1))]
        means = stage(judged.where("kept").groupBy(F.col("_lang").alias("_rl")).agg(*of), "means")
        judged = rows.join(means, F.col("_lang").eqNullSafe(F.col("_rl")), "left").withColumns({
            "class_distance": distance(F.col("_classes"), F.col("_mean_classes")), "word_distance": distance(F.col("_common"), F.col("_mean_common"))})
        fits = (F.coalesce("class_distance", F.lit(0.0)) <= class_limit) & (F.coalesce("word_distance", F.lit(0.0)) <= word_limit)
        judged = judged.withColumn("kept", ~F.col("base_failed") & fits)
    return judged.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "class_distance", "word_distance", "kept")
