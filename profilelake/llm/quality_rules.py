"""Document filters: base counts, and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into a fixed number of buckets. Two multinomials
over the buckets are counted: one over trusted documents, one over the whole
corpus. A document's score is the mean, over its words and pairs, of the log
ratio of the two, so it does not depend on the document's length. A document is
kept if it passes the base rules and its score reaches a fixed threshold; every
document gets a verdict, and the same one in every run.

The corpus counts cover all documents, the trusted ones all documents marked good.
Only counts per bucket are compared and the prior is a share of the trusted grams,
so a corpus of the same mix gives the same verdicts whatever its size.

Trusted texts meet their labels in a shuffle, however many there are, so the plan is
the same at every size. A filter of a fixed size, made of hashed trusted ids, goes in
front of it: texts that cannot be trusted are not shuffled, and what the filter lets
through by chance the join takes out.

Cases: null and empty texts have no words, score 0 and fail the base rules;
documents without trusted ones to compare with all score 0 and follow the base
rules; repeated rows are scored alike and count as often as they occur; rows without
an id are never trusted; an empty table gives no row; other columns are left aside,
whatever their names. Texts are used whole. Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profilelake.llm.common import may_hold, texts

# White space between words, symbols, limits of the base rules.
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50

BUCKETS = 16_384
THRESHOLD = -0.075
PRIOR = 0.06  # grams of the corpus's own mix that the trusted side starts with, for each of its own


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def duplicate_lines(text: Column) -> Column:
    """How many lines with a word equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, BLANK, "")) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def word_hashes(words: Column) -> Column:
    """One 64-bit hash a word; pairs and windows are hashed from these, not from the words."""
    return F.transform(words, lambda w: F.xxhash64(w))


def repeated_words(hashes: Column) -> Column:
    """How many words lie in three-word windows that the text holds twice or more.

    Windows are sorted with their places; equal neighbours are repeats. The sort is
    done only where some window repeats. Windows are equal if their 64-bit hashes are.
    """
    inner = F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0)))
    windows = F.transform(
        inner, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2))
    )

    def places(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, i: (x["window"] == F.get(ordered, i - 1)["window"])
            | (x["window"] == F.get(ordered, i + 1)["window"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    # A one-element array names an intermediate value, so that it is computed once.
    def count(windows: Column) -> Column:
        ordered = F.sort_array(
            F.transform(windows, lambda x, i: F.struct(x.alias("window"), i.alias("at")))
        )
        total = F.get(F.transform(F.transform(F.array(ordered), places), covered), F.lit(0))
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(0)

    return F.get(F.transform(F.array(windows), count), F.lit(0))


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def gram_rows(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The bucket of every word, and of every word with the next one of its text."""
    split = docs.select(words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    # Neighbours as columns of a row: both hashes are then part of the generated code.
    rest = F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(1)))
    rows = split.select(F.inline(F.arrays_zip(F.col("words").alias("word"), rest.alias("next"))))
    word, following = F.xxhash64("word"), F.xxhash64("next")
    pair = F.when(F.col("next").isNotNull(), _bucket(F.xxhash64(word, following), buckets))
    rows = rows.select(F.explode(F.array(_bucket(word, buckets), pair)).alias("bucket"))
    return rows.filter(F.col("bucket").isNotNull())


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The distinct ids of documents marked good."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
    return good.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Grams per bucket; ``buckets`` numbers, whatever the corpus."""
    counts = [0] * buckets
    for row in gram_rows(docs, buckets).groupBy("bucket").count().collect():
        counts[row["bucket"]] = row["count"]
    return counts


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """The log ratio of every bucket."""
    corpus = bucket_counts(docs, buckets)
    marked = may_hold(docs.filter("doc_id IS NOT NULL"), trusted)
    target = bucket_counts(marked.join(trusted.hint("shuffle_hash"), "doc_id", "left_semi"), buckets)
    all_, good = sum(corpus), sum(target)
    if not good:
        return [0.0] * buckets
    # The trusted side is drawn towards the corpus: a document is not rejected for few
    # words that merely were not seen there.
    return [
        math.log((t / good * all_ / c + PRIOR) / (1 + PRIOR)) if c else 0.0
        for t, c in zip(target, corpus, strict=True)
    ]


def likelihood_ratio(hashes: Column, ratios: list[float]) -> Column:
    """Mean log ratio of a document's words and pairs of neighbours; 0 if it has none."""
    known = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    first = F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0)))
    grams = F.concat(hashes, F.transform(first, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1))))
    total = F.aggregate(
        grams, F.lit(0.0), lambda a, g: a + F.get(known, _bucket(g, len(ratios)))
    )
    return F.when(F.size(hashes) > 0, total / (2 * F.size(hashes) - 1)).otherwise(0.0)


def judge(
    documents: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: base counts, score and verdict."""
    docs = texts(documents)
    ratios = log_ratios(docs, trusted_ids(labels), buckets)
    counted = (
        docs.withColumn("words", words(F.col("text")))
        .withColumn("hashes", word_hashes(F.col("words")))
        .select(
            "doc_id",
            F.size("words").cast("bigint").alias("n_words"),
            F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
            F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            duplicate_lines(F.col("text")).cast("bigint").alias("n_dup_lines"),
            repeated_words(F.col("hashes")).cast("bigint").alias("n_repeat_words"),
            likelihood_ratio(F.col("hashes"), ratios).alias("score"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        )
    )
    return counted.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
