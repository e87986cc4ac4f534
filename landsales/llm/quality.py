"""Operator 5: quality rules by a hashed n-gram likelihood ratio (DataFrame functions only).

Words ``[^\\x20\\x09-\\x0D]+`` and word pairs (the last word pairs with the end)
are hashed to ``BUCKETS``. Two multinomials are counted: over all documents (raw
corpus) and over a bounded sample of documents that labels trust (target). Raw
counts are scaled to the target's total and both get the same prior count, so a
rare bucket's ratio stays near 1. A document's score is the mean of
``log p_target - log p_raw`` over its n-grams; it is kept if the score is at
least ``THRESHOLD`` and the base rules pass. Every document is judged the same
way, nothing is drawn at random.

Base rules: at least ``MIN_WORDS`` words, and at most a fifth of the words inside
5-word windows that the text holds more than once.

Defined results: a null text has no words (it fails the base rules, its score is
null); rows with a null doc_id are judged but never trusted; repeated rows are
judged and counted each; without trusted labels all ratios are 0, so the base
rules decide; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsales.llm.common import unused

BUCKETS = 1 << 14
TARGET_DOCS = 20_000       # trusted documents the target is counted on (a bounded, hashed sample)
PRIOR = 50                 # prior count of every bucket in both multinomials
THRESHOLD = -0.05          # nats per n-gram
MIN_WORDS = 10
REPEAT_WORDS = 5           # words of a repeated window
REPEAT_PERCENT = 20
SPACES = "[ \\t-\\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def bucket(*hashes: Column) -> Column:
    return F.pmod(hashes[0] if len(hashes) == 1 else F.xxhash64(*hashes), F.lit(BUCKETS)).cast("int")


def ngram_buckets(hashes: Column) -> Column:
    """Buckets of all words and word pairs of a list of word hashes."""
    return let(hashes, lambda h: F.concat(F.transform(h, lambda x: bucket(x)),
                                          F.transform(h, lambda x, i: bucket(x, F.get(h, i + 1)))))


def repeated_words(hashes: Column) -> Column:
    """Words inside windows of REPEAT_WORDS words found twice or more.

    Windows are hashed; only texts with fewer distinct windows than windows sort
    them, and count the words the repeated ones cover."""
    def windows(h: Column) -> Column:
        starts = F.slice(h, F.lit(1), F.greatest(F.size(h) - (REPEAT_WORDS - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, REPEAT_WORDS))))

    def covered(window: Column) -> Column:
        ordered = F.sort_array(F.transform(window, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = let(ordered, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"].eqNullSafe(F.get(s, k - 1)["h"])) | (x["h"].eqNullSafe(F.get(s, k + 1)["h"]))),
            lambda x: x["i"])))
        steps = let(places, lambda p: F.transform(
            p, lambda x, k: F.least(F.lit(REPEAT_WORDS), F.coalesce(F.get(p, k + 1) - x, F.lit(REPEAT_WORDS)))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(hashes, lambda h: let(windows(h), lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w))
                                     .otherwise(F.lit(0).cast("long"))))


def trusted_sample(labels: DataFrame, limit: int = TARGET_DOCS) -> DataFrame:
    """At most ``limit`` doc_ids of quality 1, those of the smallest hashes."""
    ids = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()) \
        .select(F.col("doc_id").cast("long").alias("trusted_id")).distinct()
    return ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(limit)


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log p_target - log p_raw of every bucket. One row per bucket comes back, whatever
    the corpus; buckets are combined map-side."""
    trusted = F.broadcast(trusted_sample(labels))       # at most TARGET_DOCS ids
    rows = docs.select("doc_id", "text").join(trusted, F.col("doc_id").cast("long") == F.col("trusted_id"), "left") \
        .select(F.col("trusted_id").isNotNull().cast("long").alias("is_target"),
                F.explode(ngram_buckets(word_hashes(word_list(F.col("text").cast("string"))))).alias("bucket"))
    counted = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("is_target").alias("target")).collect()
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for row in counted:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    n_raw, n_target = sum(raw), sum(target)
    if not n_target:
        return [0.0] * BUCKETS
    scale = n_target / n_raw
    return [log((t + PRIOR) / (r * scale + PRIOR)) for t, r in zip(target, raw)]


def verdicts(text: Column, ratios: list[float], threshold: float = THRESHOLD) -> Column:
    """A struct of the measures, the score and the verdict of a text."""
    # a list of numbers that Spark folds to one literal
    ratio = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    text = F.coalesce(text.cast("string"), F.lit(""))

    def total(h: Column) -> Column:
        each = F.transform(h, lambda x, i: F.get(ratio, bucket(x)) + F.get(ratio, bucket(x, F.get(h, i + 1))))
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x)

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    measured = let(word_list(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        let(word_hashes(w), lambda h: F.struct(repeated_words(h).alias("repeat"), total(h).alias("total"))).alias("h")))

    def judged(m: Column) -> Column:
        n_words, repeat = m["n_words"], m["h"]["repeat"]
        failed = (n_words < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n_words)
        score = F.when(n_words > 0, m["h"]["total"] / (2 * n_words))
        return F.struct(
            n_words.alias("n_words"), m["word_chars"].alias("word_chars"),
            F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat.alias("n_repeat_words"), failed.alias("base_failed"), score.alias("quality_score"),
            (~failed & (score >= threshold)).alias("kept"))

    return let(measured, judged)


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "quality_score", "kept"]


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the columns of MEASURES; they replace columns of ``docs`` of the same name."""
    at = unused("verdict", docs)
    judged = docs.withColumn(at, verdicts(F.col("text"), log_ratios(docs, labels), threshold))
    return judged.select(*[judged[c] for c in docs.columns if c.lower() not in MEASURES],
                         *[F.col(at)[c].alias(c) for c in MEASURES])


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns as they are."""
    at = unused("verdict", docs)
    judged = docs.withColumn(at, verdicts(F.col("text"), log_ratios(docs, labels), threshold)["kept"])
    return judged.where(F.col(at)).drop(at)
