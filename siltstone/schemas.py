"""Declared schemas of the raw envelope, the silver tables and the gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _D, _B, _L, _TS = (
    T.StringType(),
    T.DoubleType(),
    T.BooleanType(),
    T.LongType(),
    T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


@dataclass(frozen=True)
class MetricSet:
    """Which metric names become columns of the activity table, and which one ranks it."""

    columns: tuple[tuple[str, str], ...]
    primary: str

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(column for _, column in self.columns)

    @property
    def primary_column(self) -> str:
        return dict(self.columns)[self.primary]


# Metric names as they appear in payloads, with their column names.
DEFAULT_METRICS = MetricSet(
    columns=(
        ("peakCCU", "peak_ccu"),
        ("uniquePlayers", "unique_players"),
        ("plays", "plays"),
        ("minutesPlayed", "minutes_played"),
    ),
    primary="peakCCU",
)

ENVELOPE = _struct(
    event_id=_S,
    source_name=_S,
    event_type=_S,
    event_time=_S,
    ingested_at=_S,
    request_status=_S,
    latency_ms=_D,
    payload=T.VariantType(),
)

HEALTH_EVENT = _struct(
    source=_S,
    entity=_S,
    status=_S,
    message=_S,
    observed_at=_S,
    endpoint=_S,
    topic=_S,
    http_status=_L,
    record_count=_L,
    correlation_id=_S,
    publish_status=_S,
)

OFFERS = _struct(
    snapshot_date=_S,
    offer_id=_S,
    dev_name=_S,
    regular_price=_D,
    final_price=_D,
    giftable=_B,
    refundable=_B,
    in_date=_S,
    out_date=_S,
    layout_id=_S,
    source_event_id=_S,
    ingested_at=_S,
    processed_at=_TS,
)

CATALOG = _struct(
    catalog_id=_S,
    name=_S,
    description=_S,
    rarity=_S,
    type=_S,
    set_name=_S,
    introduction_text=_S,
    source_event_id=_S,
    ingested_at=_S,
    processed_at=_TS,
)

ENTITIES = _struct(
    entity_id=_S,
    title=_S,
    creator_code=_S,
    display_name=_S,
    category=_S,
    created_in=_S,
    tags=_S,
    source_event_id=_S,
    ingested_at=_S,
    processed_at=_TS,
)

METRIC_POINTS = _struct(
    entity_id=_S,
    interval_type=_S,
    metric_name=_S,
    metric_timestamp=_S,
    metric_date=_S,
    metric_value=_D,
    source_event_id=_S,
    ingested_at=_S,
    processed_at=_TS,
)


def activity_schema(metrics: MetricSet = DEFAULT_METRICS) -> T.StructType:
    return _struct(
        entity_id=_S,
        title=_S,
        creator_code=_S,
        latest_metric_timestamp=_TS,
        **{column: _D for column in metrics.column_names},
        updated_at=_TS,
    )


HOURLY = _struct(
    entity_id=_S,
    metric_name=_S,
    metric_hour=_S,
    avg_value=_D,
    min_value=_D,
    max_value=_D,
    sample_count=_L,
)

SPIKES = _struct(
    entity_id=_S,
    title=_S,
    metric_timestamp=_TS,
    peak_ccu=_D,
    previous_peak_ccu=_D,
    rolling_avg_peak_ccu=_D,
    pct_change_from_previous=_D,
    deviation_from_rolling_avg=_D,
    anomaly_type=_S,
    severity=_S,
    detected_at=_TS,
)

CATEGORY_SHARE = _struct(
    snapshot_date=_S, rarity=_S, item_count=_L, share_pct=_D, updated_at=_TS
)

HEALTH_SUMMARY = _struct(
    source_name=_S,
    last_success_at=_TS,
    last_failure_at=_TS,
    success_count=_L,
    failure_count=_L,
    latest_status=_S,
)

RUN_SUMMARY = _struct(
    dataset=_S, input_count=_L, output_count=_L, target_path=_S, status=_S
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
