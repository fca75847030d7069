"""Summary of ingestion health events per source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.instants import instant
from siltstone.functions.pinned import filter_here
from siltstone.functions.variant import Fields

_SOURCE_KEYS = ("source", "source_name", "entity")
_TIME_KEYS = ("observed_at", "ingested_at", "event_time")


def _first_filled(df: DataFrame, names: tuple[str, ...]) -> Column:
    present = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in names if n in df.columns]
    return reduce(lambda a, b: F.coalesce(a, b), present, F.lit(None).cast("string"))


def normalise_health(events: DataFrame) -> DataFrame:
    """(source_name, status, observed_at text) from typed columns or from a VARIANT `event`."""
    if "event" in events.columns:
        read, own = Fields.read(events, "event", *_SOURCE_KEYS, "status", *_TIME_KEYS)
        found = read.select(
            own.truthy(*_SOURCE_KEYS).alias("source_name"),
            F.lower(F.coalesce(own.truthy("status"), F.lit(""))).alias("status"),
            own.truthy(*_TIME_KEYS).alias("observed_at"),
        )
    else:
        found = events.select(
            _first_filled(events, _SOURCE_KEYS).alias("source_name"),
            F.lower(F.coalesce(F.col("status").cast("string"), F.lit(""))).alias("status"),
            _first_filled(events, _TIME_KEYS).alias("observed_at"),
        )
    return filter_here(found, F.col("source_name").isNotNull())


def health_summary(events: DataFrame) -> DataFrame:
    """Counts and last times per source, and its newest status.

    Grouping by (source, status) first leaves a handful of rows per source, so a source
    with most of the events is combined map-side and never gathered in one task.
    """
    seen = normalise_health(events)
    per_status = (
        seen.select("source_name", "status", instant(seen, "observed_at").alias("at"))
        .groupBy("source_name", "status")
        .agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("n"))
    )
    succeeded, failed = F.col("status") == "success", F.col("status") == "failed"
    newest = F.struct(F.col("at").isNotNull(), F.col("at"), F.col("status"))
    return per_status.groupBy("source_name").agg(
        F.max(F.when(succeeded, F.col("at"))).alias("last_success_at"),
        F.max(F.when(failed, F.col("at"))).alias("last_failure_at"),
        F.coalesce(F.sum(F.when(succeeded, F.col("n"))), F.lit(0)).alias("success_count"),
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("failure_count"),
        F.max_by("status", newest).alias("latest_status"),
    )
