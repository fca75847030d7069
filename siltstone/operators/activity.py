"""Latest value per entity and metric, pivoted to one row per entity."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.instants import instant, stamp
from siltstone.functions.pinned import filter_here
from siltstone.schemas import DEFAULT_METRICS, MetricSet


def timed_points(points: DataFrame) -> DataFrame:
    """Points with a readable time, an entity and a metric; `ts` is the parsed time."""
    named = points.where(F.col("entity_id").isNotNull() & F.col("metric_name").isNotNull())
    timed = named.withColumn("ts", instant(named, "metric_timestamp"))
    return filter_here(timed, F.col("ts").isNotNull())


def newest_points(points: DataFrame) -> DataFrame:
    """The newest point per entity and metric, with all its columns and its time `ts`.

    Points with a value come before those without; then the later one, the later ingested one,
    the greater event id and the greater value decide, so the order is total.

    Value and time are packed into one number. Before the shuffle a task keeps the points of its greatest
    number per key, usually one, so a dominant entity costs nothing extra; only those that
    are left of a key are then told apart by ingestion time, id and value.
    """
    # Times lie within 2**60 microseconds of 1970, some 36,000 years.
    packed = F.unix_micros("ts") + F.when(F.col("metric_value").isNotNull(), F.lit(1 << 61)).otherwise(0)
    key = Window.partitionBy("entity_id", "metric_name")
    first = (
        timed_points(points).withColumn("_packed", packed)
        .withColumn("_n", F.rank().over(key.orderBy(F.desc("_packed")))).where("_n = 1")
    )
    order = []
    if "ingested_at" in points.columns:
        order.append(instant(first, "ingested_at").desc_nulls_last())
    if "source_event_id" in points.columns:
        order.append(F.col("source_event_id").desc_nulls_last())
    order.append(F.col("metric_value").desc_nulls_last())
    return (
        first.withColumn("_n", F.row_number().over(key.orderBy(*order))).where("_n = 1")
        .drop("_n", "_packed")
    )


def latest_points(points: DataFrame) -> DataFrame:
    """One row per (entity, metric): its newest non-null value, or its newest point."""
    return newest_points(points).select("entity_id", "metric_name", "metric_value", "ts")


def pivot_latest(latest: DataFrame, metrics: MetricSet = DEFAULT_METRICS) -> DataFrame:
    """Known metrics become columns; every metric counts for the latest time."""
    columns = [
        F.max(F.when(F.col("metric_name") == name, F.col("metric_value"))).alias(column)
        for name, column in metrics.columns
    ]
    return latest.groupBy("entity_id").agg(
        F.max("ts").alias("latest_metric_timestamp"), *columns
    )


def entity_titles(entities: DataFrame) -> DataFrame:
    """One (entity_id, title, creator_code) per entity: its most recently ingested record."""
    present = set(entities.columns)

    def column(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    recency = [F.col(c).desc_nulls_last() for c in ("ingested_at", "source_event_id") if c in present]
    tie = [F.col(c).asc_nulls_last() for c in ("title", "display_name", "creator_code") if c in present]
    newest = Window.partitionBy("entity_id").orderBy(*recency, *tie)
    return (
        entities.where(F.col("entity_id").isNotNull())
        .select(
            "entity_id",
            F.coalesce(column("title"), column("display_name")).alias("title"),
            column("creator_code").alias("creator_code"),
            F.row_number().over(newest).alias("_n"),
        )
        .where("_n = 1")
        .drop("_n")
    )


def with_titles(rows: DataFrame, entities: DataFrame | None, *columns: str) -> DataFrame:
    """Left join on the entity dimension. No broadcast hint: its size is for AQE to judge."""
    if entities is None:
        return rows.withColumns({c: F.lit(None).cast("string") for c in columns})
    return rows.join(entity_titles(entities).select("entity_id", *columns), "entity_id", "left")


def latest_activity(
    points: DataFrame,
    entities: DataFrame | None = None,
    *,
    metrics: MetricSet = DEFAULT_METRICS,
    run_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    return activity_from_latest(latest_points(points), entities, metrics=metrics, run_ts=run_ts)


def activity_from_latest(
    latest: DataFrame,
    entities: DataFrame | None = None,
    *,
    metrics: MetricSet = DEFAULT_METRICS,
    run_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    wide = with_titles(pivot_latest(latest, metrics), entities, "title", "creator_code")
    return wide.select(
        "entity_id",
        "title",
        "creator_code",
        "latest_metric_timestamp",
        *metrics.column_names,
        stamp(run_ts).alias("updated_at"),
    )
