"""The corpus pipeline: quality, language, near duplicates, repeated passages, packing.

Each stage takes what its predecessor kept, with the columns of `documents`, and applies one
operator of siltstone.llm. run() writes each result and reads it again for the next stage.
An empty table gives an empty table in every stage; further columns stay as they are, whatever their
names (the packing result has columns of its own).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm import config_packing, gear_dedup, jaccard_join, language_mixture, line_crf
from siltstone.llm.queries import BYTE_BPE, CAPACITY, END_ID, tokenizer
from siltstone.llm.text import free_name, small_batches
from siltstone.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Share of its main language below which a document is a jumble; two halves still pass.
LEAST_SHARE = 0.4
#: What near duplicates share: four fifths of their runs of five words.
NEAR = jaccard_join.Rule(5, 80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier takes for good. Null, empty and blank texts have no line and
    score 0: they go. Very long texts are scored whole; repeated rows are judged alike."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field, score = line_crf.learned(docs, labels), free_name(docs, "_score")
    scored = line_crf.with_scores(docs, field, docs.columns, score)
    return scored.filter(F.col(score) >= line_crf.CUT).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language. Texts that are null or have no letter go, and those in which no
    language has LEAST_SHARE; a text in a language that was not learned is taken for the nearest."""
    small_batches(spark)
    training = docs.filter(~language_mixture.held_out(F.col("doc_id")))
    languages = language_mixture.Languages.learned(training)
    return language_mixture.with_main_language(docs, languages, LEAST_SHARE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one of least doc_id, which names the
    group, or any if no row of the group has a doc_id. Groups are of texts, so different
    texts stay whatever their doc_ids; null and blank texts belong to no group and all stay."""
    small_batches(spark)
    key, number = free_name(docs, "_row_key"), free_name(docs, "_n")
    first = (
        jaccard_join.grouped(docs, NEAR).filter("root IS NOT NULL").groupBy("root")
        .agg(F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "row_key")).alias("first"))
        .select(F.col("first.row_key").alias(key)).distinct().hint("merge")
    )
    blank = F.col("text").isNull() | ~F.col("text").rlike("[^ \\t\\n\\r\\x0B\\f]")
    kept = docs.filter(~blank).withColumn(key, jaccard_join.row_key()).join(first, key, "left_semi")
    # Rows of the same doc_id and text are copies; one of them stays.
    one = kept.withColumn(number, F.row_number().over(
        Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns))
    )).filter(F.col(number) == 1)
    return one.select(*docs.columns).union(docs.filter(blank))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in an earlier document. All rows stay, null and empty
    texts as they are; n_chars, if there is one, counts what is left."""
    small_batches(spark)
    aside = {
        c: free_name(docs, f"{c}_kept") for c in docs.columns
        if c.lower() in ("removed_spans", "removed_bytes")
    }
    cut = gear_dedup.remove_repeats(docs.withColumnsRenamed(aside)).select(
        *(F.col(aside.get(c, c)).alias(c) for c in docs.columns)
    )
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences. A null or empty text is a piece of its
    end id alone; repeated rows are packed each."""
    small_batches(spark)
    return config_packing.pack_documents(docs, tokenizer(BYTE_BPE), CAPACITY, END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("language identification", language),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeated_passages),
    ("best-fit packing", packing),
]

#: The learned stages and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
