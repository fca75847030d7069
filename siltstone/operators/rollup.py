"""Hourly aggregates per entity and metric."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.instants import HOUR_TEXT
from siltstone.operators.activity import timed_points


def value_aggregates() -> list:
    """Averages and extremes skip NULL values; the sample count does not."""
    return [
        F.avg("metric_value").alias("avg_value"),
        F.min("metric_value").alias("min_value"),
        F.max("metric_value").alias("max_value"),
        F.count(F.lit(1)).alias("sample_count"),
    ]


def hourly_rollup(points: DataFrame) -> DataFrame:
    """The hour is grouped as a timestamp and becomes text only once per group."""
    hourly = (
        timed_points(points)
        .groupBy("entity_id", "metric_name", F.date_trunc("hour", "ts").alias("_hour"))
        .agg(*value_aggregates())
    )
    return hourly.select(
        "entity_id",
        "metric_name",
        F.date_format("_hour", HOUR_TEXT).alias("metric_hour"),
        "avg_value",
        "min_value",
        "max_value",
        "sample_count",
    )
