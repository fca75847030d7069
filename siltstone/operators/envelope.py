"""Raw events: building envelopes, decoding, routing, dating and naming them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import variant as V
from siltstone.functions.instants import as_date
from siltstone.functions.pinned import filter_here
from siltstone.functions.variant import Fields

# The bronze sources, and the topic endings that select them.
SOURCES = ("shop", "cosmetics", "islands", "island_metrics", "ingestion_status")
TOPIC_ENDINGS = {
    "raw.shop": "shop",
    "raw.cosmetics": "cosmetics",
    "raw.islands": "islands",
    "raw.island_metrics": "island_metrics",
    "ops.ingestion_status": "ingestion_status",
}
HEALTH_SOURCE = "ingestion_status"
#: Partition column of bronze: the day an event is stored under.
BRONZE_DAY = "event_date"

# Lists a shop payload may carry its offers in, in order of preference.
OFFER_LISTS = ("entries", "featured", "daily")

_TIME_FIELDS = ("event_time", "ingested_at", "observed_at")


def request_status(status_code: Column) -> Column:
    return F.when(status_code.between(200, 299), "success").otherwise("failed")


def build_envelopes(fetches: DataFrame, *, ingested_at: Column | None = None) -> DataFrame:
    """Fetch results (event_id, source_name, event_type, status_code, latency_ms, fetched_at,
    body as VARIANT) to raw envelopes."""
    ingested = F.col("fetched_at") if ingested_at is None else ingested_at
    return fetches.select(
        "event_id",
        "source_name",
        "event_type",
        F.col("fetched_at").alias("event_time"),
        ingested.alias("ingested_at"),
        request_status(F.col("status_code")).alias("request_status"),
        F.round("latency_ms", 2).alias("latency_ms"),
        F.col("body").alias("payload"),
    )


def decode(raw: DataFrame, column: str = "value") -> DataFrame:
    """Add `event` (VARIANT), NULL unless the text is one JSON object."""
    text = F.col(column).cast("string")
    parsed = F.try_parse_json(F.when(F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), text))
    return raw.withColumn("event", parsed)


def split_decoded(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, quarantined rows that are not JSON objects)."""
    return (
        filter_here(decoded, F.col("event").isNotNull()),
        filter_here(decoded, F.col("event").isNull()),
    )


def event_columns(decoded: DataFrame, raw: str | None = "value") -> DataFrame:
    """The fields the silver transforms read. `raw` keeps the JSON text, which is the only
    place where the order of object keys survives. Unreadable texts give a NULL payload,
    from which nothing is flattened. The bronze partition an event was read from stays with it."""
    read, own = Fields.read(decoded, "event", "event_id", "event_type", *_TIME_FIELDS)
    kept = [F.col(raw).cast("string").alias("raw")] if raw else []
    if BRONZE_DAY in decoded.columns:
        kept.append(F.col(BRONZE_DAY))
    return read.select(
        own.shown("event_id").alias("event_id"),
        own.shown("event_type").alias("event_type"),
        own.truthy("event_time").alias("event_time"),
        own.truthy("ingested_at").alias("ingested_at"),
        V.field(F.col("event"), "payload").alias("payload"),
        *kept,
    )


def _topic_source(topic: Column) -> Column:
    matches = [
        F.when((topic == ending) | topic.endswith("." + ending), F.lit(source))
        for ending, source in TOPIC_ENDINGS.items()
    ]
    return F.coalesce(*matches)


def _source(own: Fields, topic: Column | None) -> Column:
    """Bronze source of an event, NULL when nothing identifies it."""
    event_type, entity = F.trim(own.truthy("event_type")), F.trim(own.truthy("entity"))
    looks_like_health = (
        own.truthy("source").isNotNull()
        & own.truthy("status").isNotNull()
        & own.truthy("event_id").isNull()
    )
    return F.coalesce(
        *([_topic_source(topic)] if topic is not None else []),
        F.when(event_type.isin(*SOURCES), event_type),
        F.when(entity.isin(*SOURCES), entity),
        F.when(looks_like_health, F.lit(HEALTH_SOURCE)),
    )


def calendar_day(text: Column) -> Column:
    """Leading date of an ISO text, dashed or compact; NULL for an impossible date."""
    text = F.trim(text)
    dashed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10))
    compact = F.when(
        text.rlike(r"^\d{8}([T ].*)?$"),
        F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    )
    return F.coalesce(dashed, compact).try_cast("date")


def object_key(source: Column, day: Column, event_id: Column, moment: Column) -> Column:
    """Storage key of an event: punctuation leaves the time, colons become dashes in the id."""
    compact_time = F.substring(F.translate(moment, ":-.", ""), 1, 15)
    safe_id = F.translate(event_id, ":", "-")
    name = F.concat_ws("_", F.lit("raw"), source, compact_time, safe_id)
    return F.concat(
        F.lit("bronze/source="), source, F.lit("/event_date="), day.cast("string"),
        F.lit("/"), name, F.lit(".json"),
    )


def to_bronze(
    decoded: DataFrame, run_date: dt.date | str | Column, *, topic: str | None = None
) -> DataFrame:
    """Add source, event_date, event_id and object_key.

    The date is that of the first of event, ingestion and observation time that has one,
    else the run's. An event without id gets a hash of its canonical JSON, so replaying it
    gives the same id. `source` is NULL where routing failed: those rows go to quarantine.
    """
    read, own = Fields.read(
        decoded, "event", "event_id", "event_type", "entity", "source", "status", *_TIME_FIELDS
    )
    # Every text is settled in its own column first: the dates below use each several times.
    staged = read.select(
        *decoded.columns,
        _source(own, F.col(topic) if topic else None).alias("source"),
        F.coalesce(own.truthy("event_id"), _content_hash()).alias("event_id"),
        *[own.truthy(name).alias(f"_{name}") for name in _TIME_FIELDS],
    )
    times = [F.col(f"_{name}") for name in _TIME_FIELDS]
    dated = staged.withColumn(
        "event_date", F.coalesce(*[calendar_day(t) for t in times], as_date(run_date))
    )
    day = F.col("event_date")
    moment = F.coalesce(*times, day.cast("string"))
    return dated.withColumn(
        "object_key", object_key(F.col("source"), day, F.col("event_id"), moment)
    ).drop(*[f"_{name}" for name in _TIME_FIELDS])


def _content_hash() -> Column:
    return F.sha2(F.to_json("event"), 256)


def identify(decoded: DataFrame) -> DataFrame:
    """Add `event_id` as above, and `event_ts` from the first time the event has."""
    read, own = Fields.read(decoded, "event", "event_id", *_TIME_FIELDS)
    return read.select(
        *decoded.columns,
        F.coalesce(own.truthy("event_id"), _content_hash()).alias("event_id"),
        F.try_to_timestamp(own.truthy(*_TIME_FIELDS)).alias("event_ts"),
    )


def with_record_count(
    events: DataFrame, event_type: str = "event_type", raw: str | None = None
) -> DataFrame:
    """Add `record_count`: how many records the payload carries, NULL if that is unknown."""
    data, kind = F.col("_data"), F.col(event_type)
    staged = events.withColumn("_data", V.field(F.col("payload"), "data"))
    named = F.coalesce(*[_known_size(V.field_elements(data, name)) for name in OFFER_LISTS])
    staged = staged.withColumn("_named", F.when(kind == "shop", named))
    staged = with_first_list(
        staged, "_list", (kind == "shop") & F.col("_named").isNull(), raw, of_objects=False
    )
    listed = F.coalesce(_known_size(V.elements(data)), _known_size(V.members(data)))
    count = (
        F.when(kind == "shop", F.coalesce("_named", _known_size(V.elements(F.col("_list")))))
        .when(kind.isin("cosmetics", "islands"), listed)
        .when(kind == "island_metrics", F.lit(1))
    )
    return staged.withColumn("record_count", count).drop("_data", "_named", "_list")


def _known_size(items: Column) -> Column:
    size = F.size(items)
    return F.when(size >= 0, size)


def with_first_list(
    df: DataFrame, into: str, wanted: Column, raw: str | None, *, of_objects: bool
) -> DataFrame:
    """Where `wanted`, add the first non-empty list among the values of `_data`, in document
    order.

    VARIANT sorts object keys; the original order is taken from the event's JSON text if
    given. Only payloads without a known list need this, so it is kept out of the way of
    the others.
    """
    kind = "map<string,variant>" if of_objects else "variant"

    def is_candidate(_: Column, value: Column) -> Column:
        return F.try_variant_get(value, "$[0]", kind).isNotNull()

    # Candidates are a column of their own: each of the uses below would search again.
    staged = df.withColumn("_members", F.when(wanted, V.members(F.col("_data")))).withColumn(
        "_keys", F.map_keys(F.map_filter("_members", is_candidate))
    )
    first = F.get("_keys", 0)
    if raw is not None:
        written = F.json_object_keys(F.get_json_object(raw, "$.payload.data"))
        in_order = F.get(F.array_intersect(written, "_keys"), 0)
        first = F.when(F.size("_keys") > 1, F.coalesce(in_order, first)).otherwise(first)
    return staged.withColumn(into, F.try_element_at("_members", first)).drop("_members", "_keys")


def health_events(
    summary: DataFrame,
    *,
    source: Column,
    entity: Column,
    status: Column,
    observed_at: Column,
    message: Column,
    topic: Column,
    endpoint: Column | None = None,
    http_status: Column | None = None,
    record_count: Column | None = None,
    correlation_id: Column | None = None,
) -> DataFrame:
    """Health events from any run summary; failed ones carry no record count."""
    none = F.lit(None)
    blank = F.lit("")
    return summary.select(
        source.alias("source"),
        entity.alias("entity"),
        status.alias("status"),
        message.alias("message"),
        observed_at.cast("string").alias("observed_at"),
        F.coalesce(blank if endpoint is None else endpoint, blank).alias("endpoint"),
        topic.alias("topic"),
        (none if http_status is None else http_status).cast("bigint").alias("http_status"),
        F.when(status == "success", none if record_count is None else record_count)
        .cast("bigint")
        .alias("record_count"),
        F.coalesce(blank if correlation_id is None else correlation_id, blank).alias(
            "correlation_id"
        ),
        F.lit("success").alias("publish_status"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
