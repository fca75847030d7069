"""Hourly aggregates of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions.instants import HOUR_TEXT
from siltstone.operators.activity import timed_points
from siltstone.streaming.batches import BatchStore, each_batch

PARTS = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_hour", T.StringType()),
        T.StructField("sum_value", T.DoubleType()),
        T.StructField("values", T.LongType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("sample_count", T.LongType()),
    ]
)


def added_up(parts: DataFrame) -> DataFrame:
    """Parts of the same hours as one part."""
    return parts.groupBy("entity_id", "metric_name", "metric_hour").agg(
        F.sum("sum_value").alias("sum_value"),
        F.sum("values").alias("values"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("sample_count").alias("sample_count"),
    )


def hour_store(spark: SparkSession, root: str) -> BatchStore:
    return BatchStore(spark, root, PARTS, merge=added_up)


def follow_hours(
    points: DataFrame, root: str, checkpoint: str, *, once: bool = True
) -> StreamingQuery:
    """Store sums, counts and extremes per hour of every micro-batch below `root`; a point
    that is days late adds to its hour like any other."""
    store = hour_store(points.sparkSession, root)

    def take(batch: DataFrame, batch_id: int) -> None:
        hour = F.date_format(F.date_trunc("hour", "ts"), HOUR_TEXT).alias("metric_hour")
        parts = timed_points(batch).groupBy("entity_id", "metric_name", hour).agg(
            F.sum("metric_value").alias("sum_value"),
            F.count("metric_value").alias("values"),
            F.min("metric_value").alias("min_value"),
            F.max("metric_value").alias("max_value"),
            F.count(F.lit(1)).alias("sample_count"),
        )
        store.add(parts, batch_id)

    return each_batch(points, take, checkpoint, once)


def stored_hours(spark: SparkSession, root: str) -> DataFrame:
    """The hourly rollup over all batches."""
    whole = added_up(hour_store(spark, root).read())
    return whole.select(
        "entity_id", "metric_name", "metric_hour",
        (F.col("sum_value") / F.nullif(F.col("values"), F.lit(0))).alias("avg_value"),
        "min_value", "max_value", "sample_count",
    )
