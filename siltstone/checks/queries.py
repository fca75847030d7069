"""Every operator as a named query over the test tables.

Times are given as text and fractions rounded, so that another engine can state the same
result; nothing else is done to the operators' output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions import display, intents
from siltstone.functions import variant as V
from siltstone.functions.instants import instant
from siltstone.operators import activity, chunks, dedupe, envelope, flatten, health
from siltstone.operators import quality, ranking, rollup, shares, spikes
from siltstone.plans import bronze_to_silver, serving, silver_to_gold
from siltstone.plans.service import QueryService
from siltstone.session import prepare, scratch_path
from siltstone.sinks import events as event_sinks
from siltstone.sinks import tables as table_sinks
from siltstone.sources import files, samples, topics
from siltstone.sources.views import ViewRegistry, dataset_paths
from siltstone.streaming import activity as activity_stream
from siltstone.streaming import bronze as bronze_stream
from siltstone.streaming import rollup as rollup_stream
from siltstone.streaming import silver as silver_stream
from siltstone.streaming.spikes import SpikeFollower

Query = Callable[[SparkSession, str], DataFrame]

DAY_WITH_DATA = "2024-01-30"
LATER_DAY = "2024-02-15"
RUN_TS = dt.datetime(2026, 1, 5, tzinfo=dt.timezone.utc)
RUN_DATE = "2026-01-05"
#: With value 2 a task moves its files to their place itself; else the driver moves all, one by one.
EACH_TASK_COMMITS = "mapreduce.fileoutputcommitter.algorithm.version"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = prepared
    return function


def moment(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def spread(table: DataFrame) -> DataFrame:
    """A test table is one row group and so one task; stored events lie in many files."""
    return table.repartition(table.sparkSession.sparkContext.defaultParallelism)


def positioned(ordered: DataFrame) -> DataFrame:
    """An ordered result with the position of each row, so that the order is compared too."""
    return ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "position", F.row_number().over(Window.orderBy("_at"))
    ).drop("_at")


def _every(column: str, step: int, rest: int = 0) -> Column:
    return F.col(column) % step == rest


def rounded(column: str) -> Column:
    return F.round(column, 9).alias(column)


class Tables:
    """The logical tables at one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return samples.table(self.spark, self.sf_dir, name)

    def streamed(self, name: str) -> DataFrame:
        return samples.stream(self.spark, self.sf_dir, name)

    @property
    def points(self) -> DataFrame:
        return samples.metric_points(self.raw("events"))

    @property
    def entities(self) -> DataFrame:
        return samples.entities(self.raw("customer"))

    @property
    def offers(self) -> DataFrame:
        return samples.offers(self.raw("lineitem"))

    @property
    def catalog(self) -> DataFrame:
        return samples.catalog(self.raw("part"))

    @property
    def health(self) -> DataFrame:
        return samples.health_events(self.raw("orders"))

    @property
    def activity(self) -> DataFrame:
        return activity.latest_activity(self.points, self.entities)

    @property
    def hourly(self) -> DataFrame:
        return rollup.hourly_rollup(self.points)


_MEASURES = ("peak_ccu", "unique_players", "plays", "minutes_played")


# --- gold analytics -----------------------------------------------------------------------


@query
def latest_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return activity.latest_activity(t.points).select(
        "entity_id", moment("latest_metric_timestamp").alias("latest_at"), *_MEASURES
    )


@query
def latest_activity_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Tables(spark, sf_dir).activity.select(
        "entity_id", "title", "creator_code",
        moment("latest_metric_timestamp").alias("latest_at"), *_MEASURES,
    )


def _ranked(df: DataFrame) -> DataFrame:
    return df.select(
        "rank", "entity_id", "title", "peak_ccu", "unique_players", "plays",
        moment("latest_metric_timestamp").alias("latest_at"),
    )


@query
def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(ranking.rank_entities(Tables(spark, sf_dir).activity, top_n=10))


@query
def top_entities_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(ranking.rank_entities(Tables(spark, sf_dir).activity))


def _spike_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "entity_id", "title", moment("metric_timestamp").alias("spike_at"), "peak_ccu",
        "previous_peak_ccu", rounded("rolling_avg_peak_ccu"), rounded("pct_change_from_previous"),
        rounded("deviation_from_rolling_avg"), "anomaly_type", "severity",
    )


@query
def detected_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return _spike_rows(spikes.detect_spikes(t.points, t.entities))


@query
def spikes_of_hot_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows when every entity counts as too large for one task."""
    t = Tables(spark, sf_dir)
    return _spike_rows(spikes.detect_spikes(t.points, t.entities, max_rows_per_task=10))


@query
def spikes_by_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spikes.detect_spikes(Tables(spark, sf_dir).points)
    return found.groupBy("severity", "anomaly_type").agg(F.count(F.lit(1)).alias("n"))


@query
def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly_rows(Tables(spark, sf_dir).hourly)


def _hourly_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "entity_id", "metric_name", "metric_hour", rounded("avg_value"), "min_value",
        "max_value", "sample_count",
    )


@query
def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return shares.category_share(t.offers, t.catalog).select(
        "snapshot_date", "rarity", "item_count", rounded("share_pct")
    )


@query
def category_share_no_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares.category_share(Tables(spark, sf_dir).offers).select(
        "snapshot_date", "rarity", "item_count", rounded("share_pct")
    )


def _health_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "source_name", moment("last_success_at").alias("last_success"),
        moment("last_failure_at").alias("last_failure"), "success_count", "failure_count",
        "latest_status",
    )


@query
def source_health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _health_rows(health.health_summary(Tables(spark, sf_dir).health))


@query
def health_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same summary from raw JSON texts instead of typed columns."""
    t = Tables(spark, sf_dir)
    raw = t.health.select(F.to_json(F.struct("source", "status", "observed_at")).alias("value"))
    events, _ = files.load_events(raw)
    return _health_rows(health.health_summary(events))


@query
def dedupe_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest point per (entity, metric, day) with the day as the time."""
    daily = Tables(spark, sf_dir).points.select(
        "entity_id", "metric_name", "metric_date", "metric_value", "ingested_at",
        "source_event_id",
    )
    kept = dedupe.keep_newest(
        daily, ["entity_id", "metric_name", "metric_date"], ["ingested_at", "source_event_id"]
    )
    return kept.select("entity_id", "metric_name", "metric_date", "metric_value", "source_event_id")


# --- serving queries ----------------------------------------------------------------------


@query
def players_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _players(Tables(spark, sf_dir).hourly, DAY_WITH_DATA)


@query
def players_summary_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _players(Tables(spark, sf_dir).hourly, LATER_DAY)


def _players(hourly: DataFrame, as_of: str) -> DataFrame:
    found = serving.players_summary(hourly, as_of)
    money = ("active_players_today", "unique_players_today", "plays_today", "peak_ccu_today")
    return found.select(*[rounded(c) if c in money else F.col(c) for c in found.columns])


def _dated(df: DataFrame) -> DataFrame:
    changed = {
        "latest_metric_timestamp": moment("latest_metric_timestamp"),
        "data_as_of": moment("data_as_of"),
        "metric_date": F.col("metric_date").cast("string"),
    }
    return df.withColumns({k: v for k, v in changed.items() if k in df.columns})


@query
def most_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(serving.most_active(Tables(spark, sf_dir).activity, DAY_WITH_DATA))


@query
def current_ccu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(serving.current_ccu(Tables(spark, sf_dir).activity, LATER_DAY))


@query
def top_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dated(serving.top_on_day(Tables(spark, sf_dir).activity, DAY_WITH_DATA, 50))


@query
def average_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.average_today(Tables(spark, sf_dir).hourly, DAY_WITH_DATA)
    return found.withColumn("avg_peak_ccu", F.round("avg_peak_ccu", 9))


@query
def average_today_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.average_today(Tables(spark, sf_dir).hourly, LATER_DAY)
    return found.withColumn("avg_peak_ccu", F.round("avg_peak_ccu", 9))


@query
def recent_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    found = serving.recent_spikes(spikes.detect_spikes(t.points, t.entities), 25)
    return positioned(_spike_rows(found))


@query
def share_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    found = serving.share_listing(shares.category_share(t.offers, t.catalog))
    return positioned(found).select(
        "snapshot_date", "rarity", "item_count", rounded("share_pct"), "position"
    )


@query
def offer_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positioned(serving.offer_categories(Tables(spark, sf_dir).offers))


@query
def offers_in_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return serving.offers_in_category(t.offers, t.catalog, " r ", 12).withColumn(
        "final_price", F.round("final_price", 6)
    )


@query
def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = serving.source_health(health.health_summary(Tables(spark, sf_dir).health))
    return positioned(_health_rows(found))


@query
def data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    found = serving.data_freshness(
        health.health_summary(t.health), t.hourly, t.activity,
        shares.category_share(t.offers, t.catalog), LATER_DAY,
        metrics_source="1-URGENT", offers_source="2-HIGH",
    )
    times = [c for c in found.columns if c.endswith("_at") or c == "latest_metric_hour"]
    return found.withColumns({c: moment(c) for c in times})


@query
def listing_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = serving.top_on_day(Tables(spark, sf_dir).activity, DAY_WITH_DATA, 500)
    return serving.top_listing(top)


@query
def listing_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return positioned(serving.section_listing(serving.offers_in_category(t.offers, t.catalog, "R", 12)))


@query
def listing_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return positioned(serving.spike_listing(spikes.detect_spikes(t.points, t.entities)))


@query
def listing_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = health.health_summary(Tables(spark, sf_dir).health)
    return positioned(serving.health_listing(found))


@query
def display_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    sometimes = F.when(F.col("o_orderkey") % 10 != 0, price)
    return Tables(spark, sf_dir).raw("orders").select(
        "o_orderkey",
        display.number_text(sometimes).alias("whole"),
        display.number_text(price, 2).alias("cents"),
        display.percent_text(sometimes / F.lit(1000.0)).alias("percent"),
        display.moment_text(F.col("o_orderdate").cast("string")).alias("day"),
        display.shorten(F.concat_ws(" ", "o_orderpriority", "o_orderstatus"), 12, 9).alias("short"),
    )


@query
def intent_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with commands and keywords put in front of the turn's text."""
    talk = Tables(spark, sf_dir).raw("conversations")
    words = ["", "/help ", "Show TOP ISLANDS ", "shop rarity ", " \n/Menu ", "אונליין ",
             "average ", "any anomaly? ", "status "]
    opening = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("conv_id") % len(words) + 1).cast("int"))
    return talk.select(
        "conv_id", "turn", intents.intent(F.concat(opening, "text")).alias("intent")
    )


# --- bronze: envelopes, routing, chunks, rules --------------------------------------------


@query
def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).raw("orders")
    body = F.try_parse_json(F.to_json(F.struct(F.struct("o_orderkey", "o_custkey").alias("data"))))
    fetches = orders.select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.lit("orders_api").alias("source_name"),
        F.lit("islands").alias("event_type"),
        (F.col("o_orderkey") % 7 * 50 + 150).alias("status_code"),
        (F.col("o_totalprice") + 0.001).alias("latency_ms"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fetched_at"),
        body.alias("body"),
    )
    built = envelope.build_envelopes(fetches)
    return envelope.with_record_count(built).select(
        "event_id", "source_name", "event_time", "ingested_at", "request_status",
        "latency_ms", F.col("record_count").alias("records"),
    )


def _routed(t: Tables) -> DataFrame:
    decoded = envelope.decode(samples.raw_records(t.raw("events")))
    return envelope.to_bronze(decoded, RUN_DATE, topic="topic")


@query
def route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(Tables(spark, sf_dir)).select(
        "key", "source", F.col("event").isNull().alias("is_unreadable")
    )


@query
def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = _routed(Tables(spark, sf_dir)).where(F.col("event").isNotNull())
    return routed.select("key", F.col("event_date").cast("string").alias("event_date"))


@query
def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = _routed(Tables(spark, sf_dir)).where(F.col("source").isNotNull())
    return routed.select("key", "object_key")


@query
def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = event_sinks.quarantined(_routed(Tables(spark, sf_dir)))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    raw = envelope.union_all([
        samples.offer_events(t.raw("lineitem")),
        samples.catalog_events(t.raw("part")),
        samples.entity_events(t.raw("customer")),
        samples.metric_events(t.raw("events")),
    ])
    kinds = {"raw.shop": "shop", "raw.cosmetics": "cosmetics", "raw.islands": "islands",
             "raw.island_metrics": "island_metrics"}
    kind = F.coalesce(*[F.when(F.col("topic") == k, F.lit(v)) for k, v in kinds.items()])
    events = envelope.decode(raw).select(
        kind.alias("event_type"), V.field(F.col("event"), "payload").alias("payload"), "value"
    )
    counted = envelope.with_record_count(events, raw="value")
    return counted.groupBy("event_type", F.col("record_count").alias("records")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def health_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).raw("orders")
    status = F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed")
    built = envelope.health_events(
        orders, source=F.col("o_orderpriority"), entity=F.lit("orders"), status=status,
        observed_at=F.date_format("o_orderdate", "yyyy-MM-dd"), message=F.concat(F.lit("order "), F.col("o_orderkey")),
        topic=F.lit("ops.ingestion_status"), http_status=F.lit(200), record_count=F.col("o_custkey"),
        correlation_id=F.col("o_orderkey").cast("string"),
    )
    return built


@query
def chunk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = samples.document_bodies(Tables(spark, sf_dir).raw("documents"))
    return chunks.chunk_bodies(bodies, size=40).select(
        "correlation_id", "batch_index", "batch_count", "batch_size", "total_records",
        F.get("records", 0).getField("doc_id").alias("first_doc"),
        F.get("records", F.col("batch_size") - 1).getField("doc_id").alias("last_doc"),
        F.md5(F.array_join(F.transform("records", lambda r: F.md5(r.text)), "")).alias("texts"),
    )


@query
def chunk_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches written as payload JSON and read back by the catalogue's record locator."""
    bodies = samples.document_bodies(Tables(spark, sf_dir).raw("documents"))
    built = chunks.chunk_bodies(bodies, size=40).select(
        F.try_parse_json(chunks.batch_payload()).alias("batch"),
        F.try_parse_json(chunks.page_payload()).alias("page"),
    )
    meta = V.field(F.col("batch"), "ingestion_batch")
    return built.select(
        V.text(V.field(meta, "correlation_id")).alias("correlation_id"),
        V.number(V.field(meta, "batch_index")).cast("bigint").alias("batch_index"),
        V.number(V.field(V.field(F.col("page"), "meta"), "page_size")).cast("bigint").alias("page_size"),
        F.explode(chunks.records_of(F.col("batch"))).alias("record"),
    ).select(
        "correlation_id", "batch_index", "page_size",
        V.number(V.field(F.col("record"), "doc_id")).cast("bigint").alias("doc_id"),
        F.md5(V.text(V.field(F.col("record"), "text"))).alias("text_md5"),
    )


@query
def chunk_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth body loses its middle batch, and every first batch arrives twice."""
    bodies = samples.document_bodies(Tables(spark, sf_dir).raw("documents"))
    sent = chunks.chunk_bodies(bodies, size=40).drop("records")
    body = F.substring("correlation_id", 2, 20).cast("bigint")
    arrived = sent.where(~((body % 4 == 0) & (F.col("batch_index") == 1)))
    return chunks.completeness(arrived.unionByName(sent.where("batch_index = 0")))


def _judged(t: Tables) -> DataFrame:
    """Events with damaged properties, times and types, and the rules they break."""
    n = F.get_json_object("props", "$.k")
    kinds = F.array(
        F.concat(F.lit('{"k":'), n, F.lit(',"source":1,"entity":2,"ingested_at":3,"correlation_id":4}')),
        F.concat(F.lit('{"k":-1'), n, F.lit("}")),
        F.concat(F.lit('{"k":"'), n, F.lit('","source":1,"entity":2}')),
        F.concat(F.lit('{"k":'), n, F.lit(".5}")),
        F.lit('{"k":true}'),
    )
    rows = t.raw("events").select(
        "event_id",
        "event_type",
        "value",
        F.try_parse_json(F.get(kinds, (F.col("event_id") % 5).cast("int"))).alias("node"),
        F.when(F.col("event_id") % 7 == 0, "not a time")
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("at"),
    )
    rules = [
        quality.Rule("count", quality.json_non_negative_integer(V.field(F.col("node"), "k"))),
        quality.Rule("metadata", quality.has_fields(F.col("node"))),
        quality.Rule("type", quality.allowed(F.col("event_type"), ("view", "click", "purchase"))),
        quality.Rule("time", quality.readable_time(F.col("at"))),
        quality.Rule("value", quality.non_negative_integer(F.floor("value"))),
    ]
    return rows, rules


@query
def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.check(*_judged(Tables(spark, sf_dir)))
    return rejected.select("event_id", F.concat_ws(",", quality.REASONS).alias("reasons"))


@query
def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.check(*_judged(Tables(spark, sf_dir)))
    return valid.select("event_id")


@query
def dq_missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _judged(Tables(spark, sf_dir))
    missing = F.concat_ws(",", quality.missing_fields(F.col("node")))
    return rows.groupBy(missing.alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query
def dq_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = Tables(spark, sf_dir).raw("pages")
    damaged = F.when(F.col("page_id") % 3 == 0, F.split_part("url", F.lit("//"), F.lit(2))).otherwise(
        F.col("url")
    )
    return pages.select("page_id", quality.full_url(damaged).alias("is_full_url"))


@query
def dq_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean and integer text, with padding, signs and fractions."""
    words = ["1", " TRUE ", "yes", "On", "0", "no", "off", ""]
    word = F.get(F.array(*[F.lit(w) for w in words]), (F.col("o_orderkey") % 8).cast("int"))
    number = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(" -"), F.col("o_custkey")))
        .when(F.col("o_orderkey") % 4 == 1, F.col("o_totalprice").cast("string"))
        .when(F.col("o_orderkey") % 4 == 2, F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return Tables(spark, sf_dir).raw("orders").select(
        "o_orderkey",
        quality.parse_flag(word).alias("flag"),
        quality.parse_integer(number).alias("number"),
        quality.is_integer(number).alias("is_number"),
    )


# --- nested JSON to tables ----------------------------------------------------------------


@query
def nested_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label field as number, text, object and list."""
    n = F.get_json_object("props", "$.k")
    shapes = F.array(
        F.concat(F.lit('{"x":'), n, F.lit("}")),
        F.concat(F.lit('{"x":"w'), n, F.lit('"}')),
        F.concat(F.lit('{"x":{"id":"i'), n, F.lit('","name":null,"other":1}}')),
        F.concat(F.lit('{"x":{"text":"t","value":"v'), n, F.lit('"}}')),
        F.concat(F.lit('{"x":{"z":'), n, F.lit("}}")),
        F.lit('{"x":null}'),
        F.lit('{"x":false}'),
        F.lit("{}"),
    )
    node = F.try_parse_json(F.get(shapes, (F.col("event_id") % 8).cast("int")))
    nodes = Tables(spark, sf_dir).raw("events").select("event_id", node.alias("node"))
    read, own = V.Fields.read(nodes, "node", x=("id", "name"))
    x = own.child("x")
    return read.select(
        "event_id",
        V.label(x).alias("label"),
        V.number(x).alias("number"),
        V.is_truthy(x).alias("is_truthy"),
        own.truthy_label("x").alias("short_label"),
    )


def _payloads(raw: DataFrame) -> DataFrame:
    return envelope.event_columns(envelope.decode(raw))


@query
def flatten_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.offer_events(spread(Tables(spark, sf_dir).raw("lineitem")))
    return _offer_rows(flatten.flatten_offers(_payloads(raw), RUN_TS))


def _offer_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "snapshot_date", "offer_id", "dev_name", F.round("regular_price", 6).alias("regular_price"),
        F.round("final_price", 6).alias("final_price"), "giftable", "layout_id",
        "source_event_id", "ingested_at",
    )


@query
def flatten_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.catalog_events(spread(Tables(spark, sf_dir).raw("part")))
    return flatten.flatten_catalog(_payloads(raw), RUN_TS).select(
        "catalog_id", "name", "rarity", "type", "set_name", "introduction_text",
        "source_event_id", "ingested_at",
    )


@query
def flatten_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = samples.entity_events(spread(Tables(spark, sf_dir).raw("customer")))
    return flatten.flatten_entities(_payloads(raw), RUN_TS).select(
        "entity_id", "title", "creator_code", "display_name", "category", "created_in", "tags",
        "source_event_id", "ingested_at",
    )


@query
def flatten_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_rows(
        flatten.flatten_metrics(
            _payloads(samples.metric_events(spread(Tables(spark, sf_dir).raw("events")))), RUN_TS
        )
    )


def _metric_rows(df: DataFrame) -> DataFrame:
    return df.select(
        "entity_id", "interval_type", "metric_name", "metric_timestamp", "metric_date",
        "metric_value", "source_event_id", "ingested_at",
    )


# --- sinks and jobs -----------------------------------------------------------------------


@query
def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as topic records and back."""
    orders = Tables(spark, sf_dir).raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sent = event_sinks.topic_records(orders, "raw.orders", F.col("o_orderkey"))
    back = F.from_json("value", "o_orderkey bigint, o_custkey bigint, o_orderstatus string")
    return topics.records(sent).select("topic", "key", back.alias("row")).select("topic", "key", "row.*")


def _bronze_of_events(t: Tables) -> tuple[str, str]:
    root, bad = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "quarantine")
    decoded = envelope.decode(samples.raw_records(t.raw("events")))
    for _ in range(2):  # the second write replaces the first
        event_sinks.write_bronze(
            decoded, root, RUN_DATE, batch="run-1", topic="topic", quarantine=bad
        )
    return root, bad


def _bronze_counts(spark: SparkSession, root: str, bad: str) -> DataFrame:
    stored = files.read_bronze(spark, root).groupBy("source", "event_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    rejected = spark.read.schema("value string, reason string, batch string").json(bad)
    return stored.unionByName(
        rejected.groupBy(F.col("reason").alias("source")).agg(
            F.lit("-").alias("event_date"), F.count(F.lit(1)).alias("n")
        )
    )


@query
def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze_counts(spark, *_bronze_of_events(Tables(spark, sf_dir)))


@query
def dated_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older layout written by date parts and read back from its partitions."""
    root = scratch_path(spark, "dated")
    events = Tables(spark, sf_dir).raw("events")
    raw = events.select(F.to_json(F.struct("event_id")).alias("value"), "event_type", "ts")
    event_sinks.write_dated_entities(raw, root, entity=F.col("event_type"), day=F.col("ts"))
    kind = "value string, entity string, year string, month string, day string"
    return spark.read.schema(kind).text(root).groupBy("entity", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def bronze_compressed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written as compressed files counts like any other."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "bronze")
    decoded = envelope.decode(samples.raw_records(t.raw("events")))
    bronze = envelope.to_bronze(decoded, RUN_DATE, topic="topic").where("source IS NOT NULL")
    lines = bronze.select("value", "source", "event_date")
    lines.write.partitionBy("source", "event_date").option("compression", "gzip").text(root)
    return files.read_bronze(spark, root).groupBy("source", "event_date").agg(
        F.count(F.lit(1)).alias("n")
    )


def _parsed(events: DataFrame, source: str) -> DataFrame:
    """The same events by way of Parquet bronze."""
    spark, root = events.sparkSession, scratch_path(events.sparkSession, "parsed")
    event_sinks.write_parsed_bronze(
        envelope.decode(events), root, RUN_DATE, batch="run-1", topic="topic"
    )
    return files.load_parsed(spark, root, source)


@query
def parsed_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = samples.offer_events(spread(Tables(spark, sf_dir).raw("lineitem")))
    return _offer_rows(flatten.flatten_offers(_parsed(events, "shop"), RUN_TS))


@query
def parsed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = samples.metric_events(spread(Tables(spark, sf_dir).raw("events")))
    return _metric_rows(flatten.flatten_metrics(_parsed(events, "island_metrics"), RUN_TS))


@query
def topics_of_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per topic that each way of asking for topics selects."""
    records = samples.raw_records(Tables(spark, sf_dir).raw("events"))
    named = F.when(F.col("topic") == "other", "ops.ingestion_status").when(
        F.col("topic") == "x.raw.shop", "raw.shop").otherwise(F.col("topic"))
    records = records.select(F.concat(F.lit("lab."), named).alias("topic"))
    requests = {
        "full": topics.resolve_topics("lab", full=True),
        "named": topics.resolve_topics("lab", topic="lab.raw.island_metrics"),
        "default": topics.resolve_topics("lab"),
    }
    return envelope.union_all([
        records.where(F.col("topic").isin(wanted)).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(request).alias("request"), F.lit(len(wanted)).alias("topics"), "topic", "n")
        for request, wanted in requests.items()
    ])


@query
def single_event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One indented event per file, read as whole files and by lines."""
    root = scratch_path(spark, "single")
    suppliers = spread(Tables(spark, sf_dir).raw("supplier"))
    body = F.struct(F.col("s_suppkey").alias("event_id"), F.col("s_name").alias("event_type"))
    suppliers.select(
        F.to_json(body, {"pretty": "true"}).alias("value"), F.lit("shop").alias("source"),
        F.concat(F.lit("2026-01-0"), F.col("s_suppkey") % 9 + 1).alias("event_date"),
    ).write.option("maxRecordsPerFile", 1).option(EACH_TASK_COMMITS, "2").partitionBy(
        "source", "event_date"
    ).text(root)
    whole = files.read_bronze(spark, root, "shop", whole_files=True)
    lines = files.read_bronze(spark, root, "shop")
    readable = envelope.decode(lines).where("event IS NOT NULL").agg(F.count(F.lit(1))).scalar()
    return envelope.event_columns(envelope.decode(whole)).select(
        "event_id", "event_type", "event_date", readable.alias("readable_lines")
    )


@query
def readable_and_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze in which every seventh text is broken, split in one pass."""
    root = scratch_path(spark, "mixed")
    key = F.col("o_orderkey").cast("string")
    text = F.when(_every("o_orderkey", 7), F.concat(F.lit('{"event_id": '), key)).when(
        _every("o_orderkey", 7, 1), F.concat(F.lit("["), key, F.lit("]"))
    ).otherwise(F.to_json(F.struct(key.alias("event_id"))))
    Tables(spark, sf_dir).raw("orders").select(
        text.alias("value"), F.lit("shop").alias("source"),
        F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("event_date"),
    ).write.partitionBy("source", "event_date").text(root)
    good, bad = files.split_payloads(spark, root, "shop")
    return envelope.union_all([
        rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(kind).alias("kind"), "event_date", "n")
        for kind, rows in (("readable", good), ("set_aside", bad))
    ])


@query
def offers_of_both_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders as one table; the older one lacks a column, a third does not exist."""
    root = scratch_path(spark, "folders")
    offers = Tables(spark, sf_dir).offers
    new, old = offers.where("snapshot_date >= '1995-01-01'"), offers.where("snapshot_date < '1995-01-01'")
    table_sinks.write_counted(new, f"{root}/new", partition_by=("snapshot_date",))
    table_sinks.write_counted(old.drop("layout_id"), f"{root}/old", partition_by=("snapshot_date",))
    found = files.read_tables(spark, [f"{root}/{name}" for name in ("new", "none", "old")])
    return found.groupBy(F.col("snapshot_date").cast("string").alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("offers"), F.count("layout_id").alias("with_layout")
    )


@query
def views_of_the_second_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first root is empty, so the views show the second one."""
    first, second = scratch_path(spark, "first"), scratch_path(spark, "second")
    table_sinks.write_if_any(Tables(spark, sf_dir).catalog, f"{second}/catalog")
    views = ViewRegistry(spark, dataset_paths(first, first), dataset_paths(second, second))
    shown = views.refresh()
    return views.table("catalog").select(
        "catalog_id", "name", "rarity", F.lit(",".join(sorted(shown))).alias("shown")
    )


@query
def gold_without_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold job refuses to run without metric points, whatever else there is."""
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    table_sinks.write_if_any(Tables(spark, sf_dir).entities, f"{silver}/entities")
    try:
        silver_to_gold.run(spark, silver, scratch_path(spark, "bronze"), gold, RUN_TS)
        refused = False
    except silver_to_gold.MissingInput:
        refused = True
    return files.read_table(spark, f"{silver}/entities").agg(
        F.count(F.lit(1)).alias("entities"), F.lit(refused).alias("refused"),
        F.lit(files.read_table(spark, f"{gold}/latest_activity") is None).alias("nothing_written"),
    )


@query
def processing_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every silver row has the instant of its run, given here in another time zone."""
    t = Tables(spark, sf_dir)
    run_ts = RUN_TS.astimezone(dt.timezone(dt.timedelta(hours=2)))
    made = {
        "catalog": flatten.flatten_catalog(_payloads(samples.catalog_events(t.raw("part"))), run_ts),
        "entities": flatten.flatten_entities(_payloads(samples.entity_events(t.raw("customer"))), run_ts),
        "metric_points": flatten.flatten_metrics(_payloads(samples.metric_events(t.raw("events"))), run_ts),
    }
    return envelope.union_all([
        rows.groupBy(moment("processed_at").alias("processed_at")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(dataset).alias("dataset"), "processed_at", "n")
        for dataset, rows in made.items()
    ])


@query
def mirror_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies keep rows, partitions and types: counted again from the copy, by partition."""
    t = Tables(spark, sf_dir)
    source, target = scratch_path(spark, "origin"), scratch_path(spark, "mirror")
    orders = t.raw("orders").withColumn("order_day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    table_sinks.write_counted(orders, f"{source}/orders", partition_by=("order_day",))
    table_sinks.write_counted(t.raw("part"), f"{source}/part")
    copied = table_sinks.mirror(
        spark, source, target,
        {"orders": (orders.schema, ("order_day",)), "part": (t.raw("part").schema, ())},
    )
    by_day = spark.read.schema("o_orderkey long, order_day string").parquet(f"{target}/orders")
    return copied.unionByName(
        by_day.groupBy(F.concat(F.lit("orders of "), "order_day").alias("dataset"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def dynamic_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rewriting some partitions of a table leaves the others alone."""
    path = scratch_path(spark, "overwrite")
    orders = Tables(spark, sf_dir).raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    table_sinks.write_counted(orders, path, partition_by=("o_orderstatus",))
    doubled = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    table_sinks.write_counted(doubled, path, partition_by=("o_orderstatus",))
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "o_totalprice")


def _bronze_of_everything(t: Tables) -> str:
    root = scratch_path(t.spark, "bronze")
    raw = envelope.union_all([
        samples.offer_events(t.raw("lineitem")),
        samples.catalog_events(t.raw("part")),
        samples.entity_events(t.raw("customer")),
        samples.metric_events(t.raw("events")),
        t.health.select(
            F.lit("ops.ingestion_status").alias("topic"), F.lit("").alias("key"),
            F.to_json(
                F.struct("source", "status", "observed_at", F.lit(RUN_DATE).alias("ingested_at"))
            ).alias("value"),
        ),
    ])
    event_sinks.write_bronze(
        envelope.decode(raw), root, RUN_DATE, batch="run-1", topic="topic",
    )
    return root


def _both_jobs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, str]:
    """Bronze, silver and gold of the whole data set: both summaries, silver and gold root."""
    bronze = _bronze_of_everything(Tables(spark, sf_dir))
    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    first = bronze_to_silver.run(spark, bronze, silver, RUN_TS)
    second = silver_to_gold.run(spark, silver, bronze, gold, RUN_TS, top_n=10)
    return first.unionByName(second), silver, gold


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _, _ = _both_jobs(spark, sf_dir)
    return summary.select("dataset", "input_count", "output_count", "status")


def _views(spark: SparkSession, sf_dir: str) -> ViewRegistry:
    """The stored tables of a run behind the view registry, as the serving queries see them."""
    _, silver, gold = _both_jobs(spark, sf_dir)
    paths = dataset_paths(gold, silver, metric_points=f"{silver}/metric_points")
    views = ViewRegistry(spark, paths)
    views.refresh()
    return views


@query
def job_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _offer_rows(_views(spark, sf_dir).table("offers"))


@query
def job_metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_rows(_views(spark, sf_dir).table("metric_points"))


@query
def job_refresh_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then a refresh of one event date: the table stays that of the full run. Every
    second event is stored under another date than its points have."""
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    lines = envelope.decode(samples.metric_events(Tables(spark, sf_dir).raw("events")))
    event_sinks.write_bronze(lines, root, RUN_DATE, batch="run-1", topic="topic")
    days = ("2026-01-01", "2026-01-01")
    late = F.abs(F.xxhash64("value")) % 2 == 0
    moved = scratch_path(spark, "bronze")
    spark.read.schema("value string, source string, event_date string").text(root).select(
        "value", "source", F.when(late, F.lit(days[0])).otherwise(F.col("event_date")).alias("event_date")
    ).write.partitionBy("source", "event_date").text(moved)
    for options in ({}, {"days": days}):
        bronze_to_silver.run(spark, moved, silver, RUN_TS, sources=["island_metrics"], **options)
    task = next(task for task in bronze_to_silver.TASKS if task.source == "island_metrics")
    return _metric_rows(spark.read.schema(task.schema).parquet(f"{silver}/metric_points"))


@query
def job_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly_rows(_views(spark, sf_dir).table("hourly_rollup"))


@query
def job_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(spark, sf_dir).table("latest_activity").select(
        "entity_id", moment("latest_metric_timestamp").alias("latest_at"), *_MEASURES,
        (F.col("updated_at") == F.lit(RUN_TS)).alias("has_run_time"),
    )


@query
def service_top_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer of the query service over stored tables."""
    day = dt.date.fromisoformat(DAY_WITH_DATA)
    service = QueryService(_views(spark, sf_dir), today=lambda: day)
    return service.top_on_day(40).data.select("rank", "entity_id", *_MEASURES, "total_entities")


# --- streams ------------------------------------------------------------------------------


@query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    root, bad = scratch_path(spark, "bronze"), scratch_path(spark, "quarantine")
    bronze_stream.land(
        samples.raw_records(t.streamed("events")), root, scratch_path(spark, "progress"), RUN_DATE,
        quarantine=bad,
    ).awaitTermination()
    return _bronze_counts(spark, root, bad)


def _deduped(events: DataFrame) -> DataFrame:
    spark = events.sparkSession
    root = scratch_path(spark, "unique")
    bronze_stream.follow_unique(
        bronze_stream.identified(events), root, scratch_path(spark, "progress")
    ).awaitTermination()
    return bronze_stream.stored_events(spark, root).select("event_id", "key")


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record arrives twice; events are kept once."""
    t = Tables(spark, sf_dir)
    first, second = (samples.metric_events(t.streamed("events")) for _ in range(2))
    return _deduped(first.unionByName(second))


def _in_batches(rows: DataFrame, parts: int, *order: str) -> DataFrame:
    """The same rows as a stream of `parts` micro-batches, in reverse order."""
    spark = rows.sparkSession
    path = scratch_path(spark, "arrivals")
    for part in reversed(range(parts)):
        mine = F.pmod(F.xxhash64(*order), F.lit(parts)) == part
        rows.where(mine).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1")
    return reader.parquet(path)


@query
def stream_dedupe_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six micro-batches, and every event comes again days of event time later."""
    events = samples.metric_events(Tables(spark, sf_dir).raw("events"))
    again = events.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    return _deduped(_in_batches(again, 6, "key", "n").drop("n"))


def _streamed_hours(points: DataFrame) -> DataFrame:
    spark = points.sparkSession
    root = scratch_path(spark, "hours")
    rollup_stream.follow_hours(points, root, scratch_path(spark, "progress")).awaitTermination()
    return _hourly_rows(rollup_stream.stored_hours(spark, root))


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_hours(samples.metric_points(Tables(spark, sf_dir).streamed("events")))


@query
def stream_hourly_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six micro-batches, each with points of all days."""
    points = samples.metric_points(Tables(spark, sf_dir).raw("events"))
    return _streamed_hours(_in_batches(points, 6, "source_event_id"))


@query
def stream_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five micro-batches with late points."""
    t = Tables(spark, sf_dir)
    follower = SpikeFollower(spark, scratch_path(spark, "spikes"), buckets=8)
    points = _in_batches(t.points, 5, "source_event_id")
    follower.follow(points, scratch_path(spark, "progress")).awaitTermination()
    return _spike_rows(spikes.finish_spikes(follower.spikes(), t.entities, None))


@query
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five micro-batches with late points."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "latest")
    points = _in_batches(t.points, 5, "source_event_id")
    activity_stream.follow_latest(points, root, scratch_path(spark, "progress")).awaitTermination()
    return activity.latest_activity(activity_stream.stored_points(spark, root)).select(
        "entity_id", moment("latest_metric_timestamp").alias("latest_at"), *_MEASURES
    )


@query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze lines of the metric events, flattened as a stream."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "bronze")
    decoded = envelope.decode(samples.metric_events(t.raw("events")))
    event_sinks.write_bronze(decoded, root, RUN_DATE, batch="run-1", topic="topic")
    task = next(task for task in bronze_to_silver.TASKS if task.source == "island_metrics")
    lines = silver_stream.bronze_stream(spark, root, task.source)
    rows = silver_stream.flatten_stream(lines, task, RUN_TS)
    out = scratch_path(spark, "silver")
    silver_stream.write_silver(rows, task, out, scratch_path(spark, "progress")).awaitTermination()
    return _metric_rows(spark.read.schema(task.schema).parquet(out))
