"""Quality rules by a hashed n-gram likelihood ratio, in DataFrame functions alone.

A document is a bag of word n-grams (one and two words), each hashed to one of BUCKETS buckets.
Two multinomials over the buckets are counted, both over all their documents and with add-one
smoothing: one over the trusted target (documents labelled good), one over the raw corpus. A
document's score is the mean log ratio of target to raw over its n-grams, so length does not
matter, and it is kept when the score reaches THRESHOLD. The same rule holds for every document.

Simple counts stand beside it (`base_counts`); a document that fails them is not kept whatever
its score. Defined results: a null or blank text has no words, counts of 0, score 0.0, and fails;
repeated rows give repeated rows; labels may repeat or be null; other columns are ignored; empty
tables give no rows, and without trusted documents every score is 0.0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.text import SPACE_CHARS, literal_array, words_of

BUCKETS = 1 << 14
#: Mean log ratio from which a document is kept. Documents like the trusted ones lie around 0.02
#: whatever their language (the corpus is mostly good), junk around -0.2 and far below.
THRESHOLD = -0.08
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, WINDOW_WORDS, MOST_REPEATED_PERCENT = 20, 8, 30


def ngram_buckets(hashes: Column) -> Column:
    """Buckets of all one- and two-word n-grams, from the hashes of the words."""
    ones = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)))
    twos = F.zip_with(
        hashes, F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda a, b: F.when(b.isNotNull(), F.pmod(F.xxhash64(a, b), F.lit(BUCKETS))),
    )
    return F.concat(ones, F.array_compact(twos))


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def bucket_counts(documents: DataFrame) -> DataFrame:
    """bucket, n over all n-grams of all rows; at most BUCKETS rows."""
    return (
        documents.select(hashed(words_of(F.col("text"))).alias("hashes"))
        .select(F.explode(ngram_buckets(F.col("hashes"))).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("n"))
    )


def log_ratios(documents: DataFrame, trusted: DataFrame) -> list[float]:
    """Log ratio of each bucket: a fixed number of figures, from counts over all documents."""
    def logs(table: DataFrame) -> list[float]:
        counts = [1.0] * BUCKETS
        for row in bucket_counts(table).collect():  # at most BUCKETS rows
            counts[row.bucket] += row.n
        total = math.log(math.fsum(counts))
        return [math.log(c) - total for c in counts]

    raw, target = logs(documents), logs(trusted)
    return [t - r for t, r in zip(target, raw)]


def trusted_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents labelled good. The labels grow with the documents, so they are not broadcast."""
    good = labels.filter("quality = 1").select("doc_id").distinct().hint("merge")
    return documents.select("doc_id", "text").join(good, "doc_id", "left_semi")


def score(hashes: Column, ratios: list[float]) -> Column:
    """Mean log ratio over the n-grams; 0.0 without any."""
    weights = literal_array([round(x, 6) for x in ratios], "double")
    total = F.aggregate(
        ngram_buckets(hashes), F.lit(0.0), lambda s, b: s + F.get(weights, b.cast("int"))
    )
    n = 2 * F.size(hashes) - 1
    return F.when(n > 0, total / n).otherwise(0.0)


def repeated_words(hashes: Column) -> Column:
    """Words inside windows of WINDOW_WORDS words that the text has twice or more."""
    w = WINDOW_WORDS
    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - w),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(w)]),
    )

    def covered(found: Column) -> Column:
        # Windows with their places, sorted: those equal to a neighbour are repeated.
        ranked = F.sort_array(F.transform(found, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        places = F.flatten(F.transform(F.array(ranked), lambda r: F.sort_array(F.transform(
            F.filter(r, lambda s, i: (s.x == F.get(r, i + 1).x) | (s.x == F.get(r, i - 1).x)),
            lambda s: s.i,
        ))))
        # Each place adds the words up to the next place, w at most.
        return F.transform(F.array(places), lambda p: F.aggregate(
            F.sequence(F.lit(1), F.size(p) - 1),
            F.lit(w),
            lambda n, i: n + F.least(F.lit(w), F.get(p, i) - F.get(p, i - 1)),
        ))[0]

    counted = F.transform(
        F.array(windows),
        lambda f: F.when(F.size(F.array_distinct(f)) < F.size(f), covered(f)).otherwise(0),
    )[0]
    return F.when(F.size(hashes) > w, counted).otherwise(0).cast("long")


def base_counts(text: Column, words: Column, hashes: Column) -> dict[str, Column]:
    plain = F.coalesce(text, F.lit(""))
    blank = F.translate(plain, SPACE_CHARS, "")
    lines = F.filter(
        F.split(plain, "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0
    )
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(blank).cast("long"),
        "n_symbols": (F.length(blank) - F.length(F.translate(blank, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": F.transform(
            F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))
        )[0].cast("long"),
        "n_repeat_words": repeated_words(hashes),
    }


def judge_documents(
    documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, the base counts, base_failed, score and kept for every row."""
    ratios = log_ratios(documents, trusted_documents(documents, labels))
    words = documents.select("doc_id", "text").withColumn("words", words_of(F.col("text")))
    rows = words.withColumn("hashes", hashed(F.col("words")))
    counts = base_counts(F.col("text"), F.col("words"), F.col("hashes"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        rows.select("doc_id", score(F.col("hashes"), ratios).alias("score"), *[
            c.alias(name) for name, c in counts.items()
        ])
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .select("doc_id", *counts, "base_failed", "score", "kept")
    )
