"""Silver tables and health events to the six gold tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.operators.activity import latest_activity
from siltstone.operators.health import health_summary
from siltstone.operators.ranking import rank_entities
from siltstone.operators.rollup import hourly_rollup
from siltstone.operators.segments import MAX_ROWS_PER_TASK
from siltstone.operators.shares import category_share
from siltstone.operators.spikes import DEFAULT_RULES, SpikeRules, detect_spikes
from siltstone.schemas import DEFAULT_METRICS, MetricSet
from siltstone.sinks.tables import run_summary, write_if_any
from siltstone.sources.files import load_health, read_table


#: What the latest values are found by.
POINT_COLUMNS = (
    "entity_id", "metric_name", "metric_timestamp", "metric_value", "ingested_at", "source_event_id"
)


class MissingInput(ValueError):
    """A required silver table has no data."""


def with_day(hourly: DataFrame) -> DataFrame:
    """Add the day the serving queries filter by, as partition column of the stored table."""
    return hourly.withColumn("metric_date", F.substring("metric_hour", 1, 10))


def run(
    spark: SparkSession,
    silver_root: str,
    bronze_root: str,
    gold_root: str,
    run_ts: dt.datetime,
    *,
    top_n: int | None = None,
    metrics: MetricSet = DEFAULT_METRICS,
    rules: SpikeRules = DEFAULT_RULES,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Build every gold table; an empty result leaves the previous table in place.

    Only the metric points are required. Inputs are read as columns are needed: the points
    three times with different columns, which is cheaper than keeping all of them. Input rows are
    counted by the writes that read them; the offers, of which the newest snapshot alone is read, by
    their own footers in the same job.
    """
    points = read_table(spark, f"{silver_root}/metric_points", schemas.METRIC_POINTS)
    if points is None:
        raise MissingInput(f"no metric points at {silver_root}/metric_points")
    entities = read_table(spark, f"{silver_root}/entities", schemas.ENTITIES)
    offers = read_table(spark, f"{silver_root}/offers", schemas.OFFERS)
    catalog = read_table(spark, f"{silver_root}/catalog", schemas.CATALOG)
    health = _health(spark, bronze_root)
    results: list[tuple] = []

    def record(dataset: str, inputs: int, outputs: int) -> None:
        status = "success" if outputs else "empty"
        results.append((dataset, inputs, outputs, f"{gold_root}/{dataset}", status))

    seen = Observation()
    counted = points.select(*POINT_COLUMNS).observe(seen, F.count(F.lit(1)).alias("rows"))
    activity = latest_activity(counted, entities, metrics=metrics, run_ts=run_ts)
    active = write_if_any(activity, f"{gold_root}/latest_activity")
    point_rows = int(seen.get["rows"])
    record("latest_activity", point_rows, active)

    stored = read_table(spark, f"{gold_root}/latest_activity", activity.schema) if active else None
    stored = schemas.empty(spark, activity.schema) if stored is None else stored
    top = rank_entities(stored, by=metrics.primary_column, top_n=top_n)
    record("top_entities", active, write_if_any(top, f"{gold_root}/top_entities"))

    hourly = with_day(hourly_rollup(points))
    record(
        "hourly_rollup",
        point_rows,
        write_if_any(
            hourly, f"{gold_root}/hourly_rollup", partition_by=("metric_date",)
        ),
    )

    spikes = detect_spikes(
        points, entities, metrics=metrics, rules=rules, run_ts=run_ts,
        max_rows_per_task=max_rows_per_task,
    )
    record("spikes", point_rows, write_if_any(spikes, f"{gold_root}/spikes"))

    shares = (
        schemas.empty(spark, schemas.CATEGORY_SHARE)
        if offers is None
        else category_share(offers, catalog, run_ts=run_ts)
    )
    offer_rows = Observation()
    if offers is not None:
        # Counted by a subquery of the write's own job, which reads no column.
        total = offers.agg(F.count(F.lit(1))).scalar()
        shares = shares.withColumn("_offers", total).observe(offer_rows, F.max("_offers").alias("rows"))
    written = write_if_any(shares.drop("_offers"), f"{gold_root}/category_share")
    record("category_share", 0 if offers is None else int(offer_rows.get["rows"] or 0), written)

    health_rows = Observation()
    if health is None:
        summary = schemas.empty(spark, schemas.HEALTH_SUMMARY)
    else:
        summary = health_summary(health.observe(health_rows, F.count(F.lit(1)).alias("rows")))
    written = write_if_any(summary, f"{gold_root}/source_health_summary")
    record("source_health_summary", 0 if health is None else int(health_rows.get["rows"]), written)
    return run_summary(spark, results)


def _health(spark: SparkSession, bronze_root: str) -> DataFrame | None:
    try:
        return load_health(spark, bronze_root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def succeeded(summary: DataFrame) -> bool:
    """A run counts as failed only when the activity table came out empty."""
    failed = (F.col("dataset") == "latest_activity") & (F.col("status") == "empty")
    return summary.where(failed).isEmpty()
