"""Nested JSON events to typed silver tables.

Input everywhere: `event_id`, `event_time`, `ingested_at` (text), `payload` (VARIANT) and,
if the order of object keys matters, `raw` (the event's JSON text). Only projections,
filters and generators are used, so the same functions run on streams and never shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import variant as V
from siltstone.functions.instants import stamp
from siltstone.functions.pinned import filter_here
from siltstone.functions.variant import Fields
from siltstone.operators.envelope import BRONZE_DAY, OFFER_LISTS, with_first_list
from siltstone.schemas import DEFAULT_METRICS, MetricSet

RunTime = dt.datetime | Column | None

_HEAD = ("event_id", "event_time", "ingested_at")
#: Beside the columns of a silver table: the bronze day its row was made from.
SOURCE_DAY = "source_day"


def _head(events: DataFrame) -> list[str]:
    """Columns of the event that its rows are made with, the day of its bronze folder if known."""
    return [*_HEAD, *([BRONZE_DAY] if BRONZE_DAY in events.columns else [])]


def _bronze_day(rows: DataFrame) -> list[Column]:
    return [F.col(BRONZE_DAY).alias(SOURCE_DAY)] if BRONZE_DAY in rows.columns else []


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _origin(run_ts: RunTime) -> list[Column]:
    return [
        F.coalesce("event_id", F.lit("")).alias("source_event_id"),
        F.coalesce(_filled("ingested_at"), _filled("event_time"), F.lit("")).alias("ingested_at"),
        stamp(run_ts).alias("processed_at"),
    ]


def _present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def _with_data(events: DataFrame) -> DataFrame:
    raw = ["raw"] if "raw" in events.columns else []
    return events.select(*_head(events), *raw, V.field(F.col("payload"), "data").alias("data"))


def _with_offer_list(listed: DataFrame) -> DataFrame:
    """Add `offers`: a list under one of the known names, else the first list of objects."""
    data = F.col("_data")
    named = F.when(F.lit(False), data)
    for name in OFFER_LISTS:
        named = named.when(V.has_items(data, name), V.field(data, name))
    raw = "raw" if "raw" in listed.columns else None
    found = with_first_list(
        listed.withColumn("_named", named), "_list", F.col("_named").isNull(), raw, of_objects=True
    )
    return found.withColumn("offers", F.coalesce("_named", "_list"))


def flatten_offers(events: DataFrame, run_ts: RunTime = None) -> DataFrame:
    listed, body = Fields.read(_with_data(events).withColumnRenamed("data", "_data"), "_data", "date")
    day = F.substring(F.coalesce(body.truthy("date"), F.col("event_time")), 1, 10)
    listed = _with_offer_list(listed).select(*_head(listed), day.alias("day"), "offers")
    offers, offer = Fields.read(
        V.explode_node(listed, "offers", "key", "offer"), "offer",
        "offerId", "offer_id", "devName", "dev_name", "regularPrice", "regular_price",
        "finalPrice", "final_price", "giftable", "refundable", "inDate", "in_date", "outDate",
        "out_date", layout=("id", "name"),
    )
    rows = offers.select(
        F.nullif("day", F.lit("")).alias("snapshot_date"),
        offer.truthy("offerId", "offer_id").alias("offer_id"),
        offer.truthy("devName", "dev_name").alias("dev_name"),
        offer.truthy_number("regularPrice", "regular_price").alias("regular_price"),
        offer.truthy_number("finalPrice", "final_price").alias("final_price"),
        offer.flag("giftable").alias("giftable"),
        offer.flag("refundable").alias("refundable"),
        offer.truthy("inDate", "in_date").alias("in_date"),
        offer.truthy("outDate", "out_date").alias("out_date"),
        offer.truthy_label("layout").alias("layout_id"),
        *_origin(run_ts),
        *_bronze_day(offers),
    )
    return filter_here(rows, _present("offer_id"))


def flatten_catalog(events: DataFrame, run_ts: RunTime = None) -> DataFrame:
    """Records come as a list or as the values of an object; chunked batches are just events."""
    records, record = Fields.read(
        V.explode_node(_with_data(events), "data", "key", "record"), "record",
        "id", "cosmeticId", "name", "description",
        rarity=V.LABEL_KEYS, type=V.LABEL_KEYS, set=V.LABEL_KEYS,
        introduction=("text", "backendValue"),
    )
    intro = record.child("introduction")
    rows = records.select(
        record.truthy("id", "cosmeticId").alias("catalog_id"),
        record.shown("name").alias("name"),
        record.shown("description").alias("description"),
        record.label("rarity").alias("rarity"),
        record.label("type").alias("type"),
        F.when(record.truthy("set").isNotNull(), record.label("set")).alias("set_name"),
        F.when(record.is_object("introduction") | V.is_text(intro), record.truthy_label("introduction"))
        .alias("introduction_text"),
        *_origin(run_ts),
    )
    return filter_here(rows, _present("catalog_id"))


def flatten_entities(events: DataFrame, run_ts: RunTime = None) -> DataFrame:
    listed = V.explode_node(_with_data(events), "data", "key", "record").where("key is null")
    records, record = Fields.read(
        listed, "record",
        "code", "displayName", "title", "creatorCode", "creator_code", "display_name",
        "createdIn", "created_in", "tags", category=V.LABEL_KEYS,
    )
    rows = records.select(
        record.truthy("code", "displayName").alias("entity_id"),
        record.shown("title").alias("title"),
        record.truthy("creatorCode", "creator_code").alias("creator_code"),
        record.truthy("displayName", "display_name").alias("display_name"),
        record.label("category").alias("category"),
        record.truthy("createdIn", "created_in").alias("created_in"),
        record.shown("tags").alias("tags"),
        *_origin(run_ts),
    )
    return filter_here(rows, _present("entity_id"))


def _metric_entries(payload: Column, metrics: MetricSet) -> tuple[Column, Column]:
    """(known metrics of the payload, entries of its `metrics` map), both as array of
    struct<key, value>; a known metric that is absent has a NULL value."""
    known = F.array(
        *[
            F.struct(F.lit(name).alias("key"), V.field(payload, name).alias("value"))
            for name in metrics.names
        ]
    )
    return known, F.map_entries(V.field_members(payload, "metrics"))


def _has_any(payload: Column, metrics: MetricSet) -> Column:
    any_present = F.lit(False)
    for name in metrics.names:
        any_present = any_present | V.field(payload, name).isNotNull()
    return any_present


def _per_metric(events: DataFrame, metrics: MetricSet) -> DataFrame:
    """One row per event and metric, with the metric's body."""
    payload = F.col("payload")
    read, own = Fields.read(
        events, "payload", "islandCode", "island_code", "code", "interval", "intervalType",
        "interval_type",
    )
    after_colon = F.when(
        F.contains(F.col("event_id"), F.lit(":")), F.substring_index("event_id", ":", -1)
    )
    known, nested = _metric_entries(payload, metrics)
    found = read.select(
        *_head(events),
        "payload",
        F.coalesce(own.truthy("islandCode", "island_code", "code"), after_colon).alias("entity_id"),
        F.coalesce(
            own.truthy("interval", "intervalType", "interval_type"), F.lit("minute")
        ).alias("interval_type"),
        _has_any(payload, metrics).alias("has_known"),
    )
    each = found.select(
        "*", F.explode(F.when(F.col("has_known"), known).otherwise(nested)).alias("metric")
    ).where(F.col("metric.value").isNotNull())
    name, body = F.col("metric.key"), F.col("metric.value")
    # A known metric that is null looks in the `metrics` map; a name from the map looks for
    # a body of the same name in the payload first.
    beside = F.when(F.col("has_known"), V.field_members(payload, "metrics")).otherwise(
        V.members(payload)
    )
    other = F.try_element_at(beside, name)
    resolved = F.when(
        F.col("has_known"), F.when(F.is_variant_null(body), other).otherwise(body)
    ).otherwise(F.coalesce(V.non_null(other), body))
    return each.select(
        *_head(each), "entity_id", "interval_type", name.alias("metric_name"), resolved.alias("body")
    )


def flatten_metrics(
    events: DataFrame, run_ts: RunTime = None, metrics: MetricSet = DEFAULT_METRICS
) -> DataFrame:
    """Wide payloads to one row per (event, metric, point).

    A body is a list of points, or has them under `data` as a list or as an object whose
    keys are the default times.
    """
    bodies = _per_metric(events, metrics).withColumn("series", V.field(F.col("body"), "data"))
    under_data = F.col("series").isNotNull()
    bodies = bodies.withColumns(
        {"under_data": under_data, "series": F.coalesce("series", "body")}
    )
    points = V.explode_node(bodies, "series", "key", "item").where(
        F.col("under_data") | F.col("key").isNull()
    )
    points, point = Fields.read(points, "item", "timestamp", "time")
    own_value, count = point.child("value"), point.child("count")
    # A present `value` wins even when it is null; only an absent one gives way to `count`.
    value = (
        F.when(own_value.isNotNull(), V.number(own_value))
        .when(count.isNotNull(), V.number(count))
        .when(F.col("key").isNotNull(), V.number(F.col("item")))
    )
    time = F.coalesce(point.truthy("timestamp", "time"), F.nullif("key", F.lit("")))
    rows = points.select(
        "entity_id",
        "interval_type",
        "metric_name",
        time.alias("metric_timestamp"),
        F.substring(time, 1, 10).alias("metric_date"),
        value.alias("metric_value"),
        *_origin(run_ts),
        *_bronze_day(points),
    )
    return filter_here(rows, _present("metric_timestamp") & _present("entity_id"))
