"""Small tables and brute-force versions that the operators are held against."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SAMPLE = "/root/testdata/sf0.001"

#: Rows with a null in any column, empty and blank texts, copies, a repeated row, a long text.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", None),
    (4, "one", None, "a"),
    (5, "the same words stand here and there and everywhere in the text of five", "en", "a"),
    (6, "the same words stand here and there and everywhere in the text of five", "de", "b"),
    (6, "the same words stand here and there and everywhere in the text of five", "de", "b"),
    (None, "a text without a number of its own that says little", "en", "a"),
    (8, "ünïcödé 日本語 🎉 text\nwith lines\n\nand tabs\tin it", "fr", "a"),
    (9, "long " * 30_000 + "end", "en", "a"),
]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A documents table with further columns whose names clash with results."""
    wide = [(*r, "x", -1, 0.5, None) for r in rows]
    return spark.createDataFrame(
        wide,
        "doc_id long, text string, lang string, source string, vertex string, n_shingles int, "
        "score double, sig string",
    )


def odd_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD)


def no_documents(spark: SparkSession) -> DataFrame:
    return documents(spark, ODD).limit(0)


def sample_documents(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SAMPLE}/documents.parquet")


def sample_labels(spark: SparkSession) -> DataFrame:
    return spark.read.parquet(f"{SAMPLE}/labels.parquet")


def texts_of(df: DataFrame) -> list[tuple]:
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0
