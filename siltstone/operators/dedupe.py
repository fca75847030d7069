"""Optional removal of repeated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_newest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per `keys`: the highest by `order`, then by the remaining columns.

    Only the first row of a window is asked for, so Spark keeps one row per key in every task
    before the shuffle: a record repeated a billion times is shuffled once per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in (*order, *rest)]
    )
    return df.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
