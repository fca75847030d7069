"""Column expressions shared by the operators: words, numbered ranges of ids, held-out rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words; a word is a run of any other characters.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words of a text in order; none for a null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def literal_array(values: list, kind: str) -> Column:
    """A constant array column that the optimizer folds into one literal."""
    text = ",".join(repr(v) for v in values)
    return F.split(F.lit(text), ",").cast(f"array<{kind}>")


def range_bounds(table: DataFrame, key: str, rows_per_range: int) -> list[int]:
    """Greatest key of each range but the last, all of them keys of the table; ranges hold about
    `rows_per_range` rows. Reads the key column alone and returns a number per range."""
    n = table.count()
    ranges = math.ceil(n / rows_per_range)
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = table.agg(F.percentile_approx(key, shares, 100 * ranges).alias("b")).first().b
    top = table.agg(F.max(key).alias("m")).first().m
    return sorted({b for b in found or [] if b != top})


def range_number(key: Column, bounds: list[int]) -> Column:
    """Number of bounds below `key`, by binary search over a constant array."""
    if not bounds:
        return F.lit(0)
    levels = len(bounds).bit_length()
    array = literal_array(bounds, "bigint")
    powers = F.lit([1 << i for i in range(levels - 1, -1, -1)])
    return F.aggregate(
        powers,
        F.lit(0),
        lambda at, power: F.when(
            F.coalesce(F.get(array, at + power - 1) < key, F.lit(False)), at + power
        ).otherwise(at),
    )


#: Rows and bytes that Spark hands to Python at a time; texts are long, and some very long.
BATCH_ROWS, BATCH_BYTES = 1000, "4m"


def free_name(table: DataFrame, base: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in table.columns}
    while base.lower() in taken:
        base += "_"
    return base


def small_batches(spark: SparkSession) -> None:
    """Let a task hold BATCH_ROWS rows and about BATCH_BYTES in Python and its Arrow buffers, not 10,000
    rows and 64 MB. A single longer row is still one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
