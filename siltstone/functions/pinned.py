"""A filter that stays above the projection its columns come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TASK = "_task"


def filter_here(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on computed columns without computing them twice.

    Spark moves a filter below a projection by putting the projection's expressions in
    place of its columns: a JSON text would be parsed once per mention in the filter, and
    again for the result. A projection with a non-deterministic column is not crossed, and
    the task number is the cheapest one. Filters on stored columns belong below, as plain
    `where`, so that they reach the scan.
    """
    pinned = df.withColumn(_TASK, F.spark_partition_id())
    return pinned.where((F.col(_TASK) >= 0) & condition).drop(_TASK)
