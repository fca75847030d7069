"""Bottom-k document fingerprints, in DataFrame functions alone.

The sketch of a document is the sorted list of the k smallest hashes of its five-word shingles
(lower case; a document with fewer words is one shingle, one without words none). Sketches merge:
the sketch of a union is the k smallest of both sketches. They estimate

  resemblance   share of the k smallest hashes of the union that both sketches have,
  containment   resemblance times distinct shingles of the union over those of one side,
  distinct      (k - 1) over the k-th hash as a share of the range; below k hashes the count.

Defined results: null and blank texts have the empty sketch; two empty sketches are alike (1.0),
an empty one and another are not (0.0). Equal texts have equal sketches. Every row keeps its own
result, also repeated ones; rows without doc_id come last in order of doc_id. Columns other than
doc_id and text are ignored, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.text import range_bounds, range_number, words_of

K, SHINGLE_WORDS, HASH_BITS = 256, 5, 40
#: Documents of one range of doc_ids, about; a range is sorted in one task.
RANGE_DOCUMENTS = 10_000


def sketch(words: Column, k: int = K) -> Column:
    """Bottom-k sketch of an array of words (a column that is cheap to repeat)."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    n = F.size(words)
    last = F.lit(SHINGLE_WORDS - 1)

    def shingles(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - 1 - last)
        return F.transform(at, lambda i: cut(F.xxhash64(*[
            F.get(h, i + j) for j in range(SHINGLE_WORDS)
        ])))

    def cut(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - HASH_BITS)

    # A list of one list, so that the hashes are computed once and then looked into.
    many = F.flatten(F.transform(F.array(hashes), shingles))
    one = F.array(cut(F.xxhash64(F.array_join(words, " "))))
    found = F.when(n >= SHINGLE_WORDS, many).when(n > 0, one)
    return F.coalesce(
        F.slice(F.sort_array(F.array_distinct(found)), 1, k), F.array().cast("array<bigint>")
    )


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    union = merged(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(shared / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles behind a sketch."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        F.lit(float(k - 1) * (1 << HASH_BITS)) / (F.element_at(a, -1) + 1)
    )


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first one's shingles that the second one has; 1 if it has none."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), both / distinct_shingles(a, k))
    )


def as_text(a: Column) -> Column:
    """A sketch as one string, a fixed number of hexadecimal digits for each hash."""
    digits = HASH_BITS // 4
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), digits, "0")), "")


def from_text(text: Column) -> Column:
    """The sketch that `as_text` wrote."""
    digits = HASH_BITS // 4
    starts = F.sequence(F.lit(0), (F.length(text) / digits).cast("int") - 1)
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(starts, lambda i: F.conv(
            F.substring(text, i * digits + 1, F.lit(digits)), 16, 10
        ).cast("bigint"))
    )


def with_sketch(documents: DataFrame, k: int = K) -> DataFrame:
    """Adds the sketch of `text` as the column `sketch`."""
    return documents.withColumn("_words", words_of(F.lower("text"))).withColumn(
        "sketch", sketch(F.col("_words"), k)
    ).drop("_words")


def with_next(documents: DataFrame) -> DataFrame:
    """doc_id, text and next_text, the text of the following document in descending order of
    doc_id (of the first, after the last).

    Ranges of doc_ids are sorted apart. The greatest document of a range, known from its bound,
    also goes to the range above, where it comes last; that of the topmost goes to the lowest.
    """
    low = F.lit(-(1 << 63))
    rows = documents.select(
        F.coalesce("doc_id", low).alias("place"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    keys = documents.select(F.coalesce("doc_id", low).alias("place"))
    bounds = range_bounds(keys, "place", RANGE_DOCUMENTS)
    top = keys.agg(F.max("place").alias("m")).first().m
    place = F.col("place")
    own = range_number(place, bounds)
    above = F.when(place == F.lit(top), F.lit(0))
    if bounds:
        is_bound = range_number(place + 1, bounds) > F.col("own")
        above = above.when(is_bound, F.col("own") + 1)
    dealt = (
        rows.withColumn("own", own)
        .withColumn("to", F.array_compact(F.array(
            F.struct(F.lit(0).alias("guest"), F.col("own").alias("range")),
            F.when(above.isNotNull(), F.struct(F.lit(1).alias("guest"), above.alias("range"))),
        )))
        .select("place", "doc_id", "text", F.inline("to"))
    )
    order = Window.partitionBy("range").orderBy("guest", F.desc("place"), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order))


def fingerprint_documents(documents: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of the document replaced by the start of the next one.
    """
    order = Window.partitionBy("range").orderBy("guest", F.desc("place"), "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    return (
        with_next(documents)
        .withColumn("n_chars", F.length("text"))
        .withColumn("edited", F.when(
            F.col("guest") == 0,
            F.concat(
                F.substring(F.col("text"), F.lit(1), F.col("n_chars") - half),
                F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
            ),
        ))
        .withColumn("words", words_of(F.lower("text")))
        .withColumn("edited_words", words_of(F.lower("edited")))
        .select(
            "range", "guest", "place", "doc_id", "text", "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            sketch(F.col("words"), k).alias("sketch"),
            sketch(F.col("edited_words"), k).alias("edited_sketch"),
        )
        .withColumn("next_sketch", F.lead("sketch").over(order))
        .filter("guest = 0")
        .select(
            "doc_id",
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            as_text(F.col("sketch")).alias("fingerprint"),
            as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
            resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
            resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        )
    )
