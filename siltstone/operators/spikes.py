"""Spike detection: each point of one metric against everything seen before it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.instants import instant, stamp
from siltstone.functions.pinned import filter_here
from siltstone.operators.activity import with_titles
from siltstone.operators.segments import MAX_ROWS_PER_TASK, running_history
from siltstone.schemas import DEFAULT_METRICS, MetricSet

# A total order: rows that are equal in all of it are interchangeable.
ORDER = ["ts", "ingested_at", "source_event_id", "value"]


@dataclass(frozen=True)
class SpikeRules:
    # Thresholds of the two rules and of the "high" severity.
    over_average: float = 1.5
    over_previous: float = 0.5
    high_over_average: float = 2.0
    high_over_previous: float = 1.0
    # Averages below this are not compared with; None also compares with an average of 0.
    min_baseline: float | None = None


DEFAULT_RULES = SpikeRules()


def primary_points(points: DataFrame, metrics: MetricSet = DEFAULT_METRICS) -> DataFrame:
    """Non-null, timed points of the primary metric: the only ones that matter here.

    A NULL point is never reported and adds nothing to an average or a previous value.
    """
    if "metric_name" in points.columns:
        points = points.where(F.col("metric_name") == metrics.primary)
    for name in ("ingested_at", "source_event_id"):
        if name not in points.columns:
            points = points.withColumn(name, F.lit(None).cast("string"))
    points = points.where(F.col("entity_id").isNotNull() & F.col("metric_value").isNotNull())
    timed = points.select(
        "entity_id",
        instant(points, "metric_timestamp").alias("ts"),
        F.col("metric_value").cast("double").alias("value"),
        "ingested_at",
        "source_event_id",
    )
    return filter_here(timed, F.col("ts").isNotNull())


def judge(history: DataFrame, rules: SpikeRules = DEFAULT_RULES) -> DataFrame:
    """Keep the rows of a running history that count as spikes."""
    value, previous = F.col("value"), F.col("prior_value")
    average = F.col("prior_sum").cast("double") / F.col("prior_count")
    seen = history.where(F.col("prior_count") > 0).select(
        "entity_id", "ts", "value", "prior_value", average.alias("average"),
        F.when(previous != 0, (value - previous) / previous)
        .when(value > 0, F.lit(1.0))
        .alias("change"),
    )
    average, change = F.col("average"), F.col("change")
    comparable = F.lit(True) if rules.min_baseline is None else average >= rules.min_baseline
    over_average = comparable & (value >= average * rules.over_average)
    over_previous = F.coalesce(change >= rules.over_previous, F.lit(False))
    high = F.coalesce(change >= rules.high_over_previous, F.lit(False)) | (
        comparable & (value >= average * rules.high_over_average)
    )
    kinds = F.concat_ws(
        ",",
        F.when(over_average, F.lit("spike_vs_rolling_avg")),
        F.when(over_previous, F.lit("spike_vs_previous")),
    )
    return seen.where(over_average | over_previous).select(
        "entity_id",
        F.col("ts").alias("metric_timestamp"),
        value.alias("peak_ccu"),
        previous.alias("previous_peak_ccu"),
        average.alias("rolling_avg_peak_ccu"),
        change.alias("pct_change_from_previous"),
        (value - average).alias("deviation_from_rolling_avg"),
        kinds.alias("anomaly_type"),
        F.when(high, F.lit("high")).otherwise("medium").alias("severity"),
    )


def detect_spikes(
    points: DataFrame,
    entities: DataFrame | None = None,
    *,
    metrics: MetricSet = DEFAULT_METRICS,
    rules: SpikeRules = DEFAULT_RULES,
    run_ts: dt.datetime | Column | None = None,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    history = running_history(
        primary_points(points, metrics),
        "entity_id",
        ORDER,
        "value",
        max_rows_per_task=max_rows_per_task,
    )
    return finish_spikes(judge(history, rules), entities, run_ts)


def finish_spikes(
    spikes: DataFrame, entities: DataFrame | None, run_ts: dt.datetime | Column | None
) -> DataFrame:
    titled = with_titles(spikes, entities, "title")
    return titled.select(
        "entity_id",
        "title",
        *[c for c in spikes.columns if c != "entity_id"],
        stamp(run_ts).alias("detected_at"),
    )
