"""The logical tables of the pipeline, expressed over the fixed test tables.

Every view reads its whole table. NULLs, zeros, blanks and repeated records are put in by
arithmetic on ids, so that an independent SQL text can state the same thing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.instants import iso_text

METRIC_OF_EVENT = {
    "view": "peakCCU",
    "click": "uniquePlayers",
    "purchase": "plays",
    "signup": "minutesPlayed",
}
UNMAPPED_METRIC = "errors"
STATUS_OF_ORDER = {"F": "success", "O": "failed", "P": "stale"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lookup(column: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    result = F.lit(default).cast("string")
    for key, value in reversed(list(mapping.items())):
        result = F.when(column == key, value).otherwise(result)
    return result


def _every(column: str, step: int, rest: int = 0) -> Column:
    return F.col(column) % step == rest


def tied_time(moment: Column) -> Column:
    once = F.date_trunc("month", moment) + F.expr("INTERVAL 29 DAYS 12 HOURS")
    return (
        F.when(_every("event_id", 5), F.date_trunc("day", moment))
        .when(_every("event_id", 5, 1), once)
        .otherwise(moment)
    )


def metric_points(events: DataFrame) -> DataFrame:
    """Long metric points. A fifth of them falls on the start of its day and a fifth on one
    instant of its month, and a thousand events share an ingestion time: points of an entity
    tie, and only the event id tells them apart."""
    moment = tied_time(F.col("ts").cast("timestamp"))
    ingested = F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("event_id") / 1000))
    return events.select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.lit("minute").alias("interval_type"),
        _lookup(F.col("event_type"), METRIC_OF_EVENT, UNMAPPED_METRIC).alias("metric_name"),
        iso_text(moment).alias("metric_timestamp"),
        F.date_format(moment, "yyyy-MM-dd").alias("metric_date"),
        F.when(_every("event_id", 11), F.lit(None).cast("double"))
        .when(_every("event_id", 13), F.lit(0.0))
        .otherwise(F.col("value"))
        .alias("metric_value"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("source_event_id"),
        iso_text(ingested).alias("ingested_at"),
    )


def entities(customer: DataFrame) -> DataFrame:
    """Entity dimension with missing members (a quarter has other ids than the points) and
    older, differently titled copies."""
    key = F.col("c_custkey").cast("string")
    name = F.when(_every("c_custkey", 4, 3), F.concat(F.lit("x"), key)).otherwise(key)
    current = customer.select(
        name.alias("entity_id"),
        F.when(~_every("c_custkey", 5), F.col("c_name")).alias("title"),
        F.col("c_nationkey").cast("string").alias("creator_code"),
        F.col("c_mktsegment").alias("display_name"),
        F.lit("2024-02-01T00:00:00+00:00").alias("ingested_at"),
    )
    older = customer.where(_every("c_custkey", 6)).select(
        name.alias("entity_id"),
        F.concat(F.lit("Old "), "c_name").alias("title"),
        F.lit("0").alias("creator_code"),
        F.col("c_mktsegment").alias("display_name"),
        F.lit("2024-01-01T00:00:00+00:00").alias("ingested_at"),
    )
    return current.unionByName(older)


def offers(lineitem: DataFrame) -> DataFrame:
    """One offer per order line; the snapshot is the month of shipping."""
    return lineitem.select(
        F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd").alias("snapshot_date"),
        F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber")).alias("offer_id"),
        F.col("l_partkey").cast("string").alias("dev_name"),
        F.col("l_extendedprice").alias("regular_price"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("final_price"),
        F.when(_every("l_partkey", 9), F.lit(None).cast("string"))
        .when(_every("l_partkey", 8), F.lit("  "))
        .otherwise(F.col("l_returnflag"))
        .alias("layout_id"),
    )


def catalog(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("catalog_id"),
        F.when(~_every("p_partkey", 7), F.col("p_name")).alias("name"),
        F.when(_every("p_partkey", 10), F.lit("")).otherwise(F.col("p_brand")).alias("rarity"),
        F.lit("2024-02-01T00:00:00+00:00").alias("ingested_at"),
    )


def health_events(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderpriority").alias("source"),
        F.lit("orders").alias("entity"),
        F.upper(_lookup(F.col("o_orderstatus"), STATUS_OF_ORDER)).alias("status"),
        iso_text(
            F.timestamp_seconds(
                F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                + F.col("o_orderkey") % 86400
            )
        ).alias("observed_at"),
    )


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream; a file source wants a folder and a name pattern."""
    kind = table(spark, sf_dir, name).schema
    return (
        spark.readStream.schema(kind).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    )


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))


def _shapes(key: str, *shapes: Callable[[], Column]) -> Column:
    """Give row i the JSON shape number i modulo their count."""
    result = F.lit(None).cast("string")
    for number, shape in reversed(list(enumerate(shapes))):
        result = F.when(_every(key, len(shapes), number), shape()).otherwise(result)
    return result


def _named(**fields: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def offer_events(lineitem: DataFrame) -> DataFrame:
    """Raw offer events, one per order line, in four payload shapes."""
    rows = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                           "l_discount", "l_returnflag", "l_shipdate")
    snapshot = F.date_format(F.trunc("l_shipdate", "month"), "yyyy-MM-dd")
    offer_id = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
    name = F.col("l_partkey").cast("string")
    price = F.col("l_extendedprice")
    final = F.when(F.col("l_linenumber") == 1, F.lit(0.0)).otherwise(
        price * (1 - F.col("l_discount"))
    )
    section = F.col("l_returnflag")
    first = F.col("l_linenumber") == 1
    event = {
        "event_id": F.concat(F.lit("offer:"), offer_id),
        "event_type": F.lit("shop"),
        "event_time": F.concat(snapshot, F.lit("T08:00:00Z")),
    }

    def camel(**more: Column) -> Column:
        return _named(
            offerId=offer_id, devName=name, regularPrice=price, finalPrice=final,
            giftable=first, layout=_named(id=section), **more
        )

    def in_entries() -> Column:
        no_id = _named(
            offerId=F.lit(""), devName=name, regularPrice=price, finalPrice=final,
            giftable=first, layout=_named(id=section),
        )
        data = _named(date=snapshot, entries=F.array(camel(), no_id))
        return _json(**event, ingested_at=F.lit("2026-01-01T00:00:00Z"), payload=_named(data=data))

    def in_featured() -> Column:
        offer = _named(
            offer_id=offer_id, dev_name=name, regular_price=price, final_price=final,
            layout=section,
        )
        data = _named(entries=F.array().cast("array<string>"), featured=F.array(offer))
        return _json(**event, payload=_named(data=data))

    def in_daily() -> Column:
        offer = _named(
            offerId=offer_id, devName=name, regularPrice=price.cast("string"),
            finalPrice=final, giftable=first, layout=_named(name=section),
        )
        return _json(**event, payload=_named(data=_named(daily=F.array(offer))))

    def in_other_list() -> Column:
        decoy = camel(note=F.lit("a later list"))
        data = _named(
            words=F.array(F.lit("not"), F.lit("objects")),
            zone=F.array(camel(note=F.lit("the first list of objects"))),
            area=F.array(decoy, decoy),
        )
        return _json(**event, payload=_named(data=data))

    value = _shapes("l_orderkey", in_entries, in_featured, in_daily, in_other_list)
    return rows.select(F.lit("raw.shop").alias("topic"), offer_id.alias("key"), value.alias("value"))


def catalog_events(part: DataFrame) -> DataFrame:
    """Raw catalogue events, one per part, in three payload shapes."""
    key = F.col("p_partkey").cast("string")
    event = {
        "event_id": F.concat(F.lit("catalog:"), key),
        "event_type": F.lit("cosmetics"),
        "event_time": F.lit("2026-01-02T00:00:00Z"),
        "ingested_at": F.lit("2026-01-02T00:00:05Z"),
    }
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")

    def listed() -> Column:
        record = _named(
            id=key, name=name, rarity=_named(value=brand), type=_named(name=kind),
            set=_named(value=F.lit("Set A")), introduction=_named(text=F.lit("Intro")),
        )
        data = F.array(record, record.withField("id", F.lit("")))
        return _json(**event, payload=_named(data=data))

    def keyed() -> Column:
        record = _named(id=key, name=name, rarity=brand, type=kind, introduction=F.lit("S1"))
        return _json(**event, payload=_named(data=_named(only=record, note=F.lit("text"))))

    def aliased() -> Column:
        record = _named(
            cosmeticId=key, name=name, rarity=_named(id=brand), type=_named(text=kind),
            set=F.lit(""), introduction=_named(backendValue=F.lit("B1")),
        )
        return _json(**event, payload=_named(data=F.array(record)))

    value = _shapes("p_partkey", listed, keyed, aliased)
    return part.select(F.lit("raw.cosmetics").alias("topic"), key.alias("key"), value.alias("value"))


def entity_events(customer: DataFrame) -> DataFrame:
    """Raw entity events, one per customer, in three payload shapes."""
    key = F.col("c_custkey").cast("string")
    event = {
        "event_id": F.concat(F.lit("entity:"), key),
        "event_type": F.lit("islands"),
        "event_time": F.lit("2026-01-03T00:00:00Z"),
    }
    name, nation, segment = F.col("c_name"), F.col("c_nationkey").cast("string"), F.col("c_mktsegment")

    def coded() -> Column:
        record = _named(
            code=key, title=name, creatorCode=nation, displayName=segment, category=segment,
            createdIn=F.lit("v5"), tags=F.array(segment, F.lit("fun")),
        )
        return _json(**event, payload=_named(data=F.array(record)))

    def named_only() -> Column:
        record = _named(displayName=name, creator_code=nation, tags=segment,
                        category=_named(value=segment), created_in=F.lit("v4"))
        return _json(**event, payload=_named(data=F.array(record)))

    def bare() -> Column:
        record = _named(code=F.col("c_custkey"), title=name, display_name=segment,
                        category=_named(name=segment))
        return _json(**event, payload=_named(data=F.array(record)))

    value = _shapes("c_custkey", coded, named_only, bare)
    return customer.select(F.lit("raw.islands").alias("topic"), key.alias("key"), value.alias("value"))


def metric_events(events: DataFrame) -> DataFrame:
    """Raw metric events, one per event row, in six payload shapes.

    The metric is a key of the payload, so the JSON is put together as text.
    """
    rows = events.select(
        "event_id",
        F.col("user_id").cast("string").alias("entity"),
        _lookup(F.col("event_type"), METRIC_OF_EVENT, UNMAPPED_METRIC).alias("metric"),
        iso_text(F.col("ts").cast("timestamp")).alias("at"),
        F.col("value").cast("string").alias("amount"),
    )
    quote = {"e": F.col("entity"), "m": F.col("metric"), "t": F.col("at"), "v": F.col("amount"),
             "i": F.col("event_id").cast("string")}

    def filled(template: str) -> Column:
        """Template with @e @m @t @v @i standing for entity, metric, time, value, id."""
        pieces: list[Column] = []
        for number, piece in enumerate(template.split("@")):
            if number == 0:
                pieces.append(F.lit(piece))
            else:
                pieces += [quote[piece[0]], F.lit(piece[1:])]
        return F.concat(*pieces)

    head = '{"event_id":"run@i:@e","ingested_at":"2026-01-04T00:00:00Z","payload":'
    shapes = (
        '{"@m":{"data":[{"timestamp":"@t","value":@v},'
        '{"timestamp":"2026-01-04T00:00:00Z","value":null,"count":3},{"value":1},7]}}}',
        '{"islandCode":"own-@e","interval":"hour","@m":{"data":{"@t":@v}}}}',
        '{"@m":{"data":{"k":{"time":"@t","count":@v}}}}}',
        '{"code":"c-@e","intervalType":"day","@m":[{"time":"@t","value":"@v"}]}}',
        '{"metrics":{"custom":{"data":[{"timestamp":"@t","value":@v}]}}}}',
        '{"@m":null,"metrics":{"@m":{"data":[{"timestamp":"@t","value":@v}]}}}}',
    )
    value = _shapes("event_id", *[lambda s=s: filled(head + s) for s in shapes])
    return rows.select(
        F.lit("raw.island_metrics").alias("topic"),
        F.concat_ws(":", F.col("event_id"), F.col("entity")).alias("key"),
        value.alias("value"),
    )


def raw_records(events: DataFrame) -> DataFrame:
    """Topic records of every kind the bronze layer has to tell apart, two of them bad."""
    moment = F.col("ts").cast("timestamp")
    number = F.col("event_id").cast("string")
    at = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    day = F.date_format(moment, "yyyy-MM-dd")
    value = _shapes(
        "event_id",
        lambda: _json(event_id=F.concat(F.lit("a:"), number), event_time=at),
        lambda: _json(event_id=number, event_type=F.lit("cosmetics"), event_time=F.lit("2026-13-45"),
                      ingested_at=at),
        lambda: _json(event_id=number, entity=F.lit(" islands "), event_time=F.lit("soon"),
                      observed_at=day),
        lambda: _json(source=F.lit("feed"), status=F.lit("success"), n=F.col("event_id"),
                      observed_at=at),
        lambda: _json(event_id=number, note=F.lit("nobody's")),
        lambda: F.concat(F.lit("["), number, F.lit(", not an object")),
        lambda: _json(event_id=number, event_type=F.lit("shop"),
                      ingested_at=F.date_format(moment, "yyyyMMdd'T'HHmmss")),
    )
    topic = F.when(_every("event_id", 7), F.lit("x.raw.shop")).when(
        _every("event_id", 7, 6), F.lit("raw.island_metrics")
    ).otherwise(F.lit("other"))
    return events.select(topic.alias("topic"), number.alias("key"), value.alias("value"))


BODY_SIZE = 100


def document_bodies(documents: DataFrame) -> DataFrame:
    """Response bodies of up to 100 documents: ids are unique, so no body can grow."""
    record = F.struct("doc_id", "lang", "n_chars", "text")
    return (
        documents.groupBy(F.floor(F.col("doc_id") / BODY_SIZE).alias("_body"))
        .agg(F.array_sort(F.collect_list(record)).alias("records"))
        .select(F.concat(F.lit("c"), F.col("_body")).alias("correlation_id"), "records")
    )
