"""Raw records to bronze, and dropping replayed events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions.pinned import filter_here
from siltstone.operators.envelope import decode, identify
from siltstone.operators.dedupe import keep_newest
from siltstone.session import materialize
from siltstone.sinks.events import write_bronze
from siltstone.streaming.batches import BatchStore, each_batch


def land(
    records: DataFrame,
    root: str,
    checkpoint: str,
    run_date: dt.date | str | Column,
    *,
    quarantine: str,
    topic: str | None = "topic",
    label: str = "stream",
    once: bool = True,
) -> StreamingQuery:
    """Store a stream of (topic, key, value) in bronze; with `once`, drain and stop.

    Each micro-batch is one bronze batch, replaced as a whole when it is repeated.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        kept = decode(batch).persist()
        write_bronze(
            kept, root, run_date, batch=f"{label}-{batch_id}", topic=topic, quarantine=quarantine
        )
        kept.unpersist()

    writer = records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def identified(records: DataFrame) -> DataFrame:
    """Decoded records with `event_id` and `event_ts` for de-duplication."""
    return identify(filter_here(decode(records), F.col("event").isNotNull()))


EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("value", T.StringType()),
        T.StructField("event_date", T.StringType()),
    ]
)


#: Bits of the bitmap of a date, of which a row holds some (a fixed value of Spark's functions).
DATE_BITS, ROW_BITS = 1 << 24, 1 << 15
#: Dates named in the filter of the stored events; beyond, Spark prunes them by the join.
DATES = 1000
#: Dates of their own among which events without a readable time are dealt.
UNTIMED = 64

KNOWN = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]
)


def event_store(spark: SparkSession, root: str) -> BatchStore:
    return BatchStore(spark, f"{root}/events", EVENTS, partition_by=("event_date",))


def known_store(spark: SparkSession, root: str) -> BatchStore:
    """Which ids may have been stored: a bitmap per date, kept as its rows that have a bit."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("event_date", "row").agg(F.bitmap_or_agg("bits").alias("bits"))

    return BatchStore(spark, f"{root}/known", KNOWN, merge=merge)


def _place() -> Column:
    """Bit of an event id in the bitmap of its date, from 1."""
    return F.pmod(F.xxhash64("event_id"), F.lit(DATE_BITS)) + 1


def event_date() -> Column:
    share = F.pmod(F.xxhash64("event_id"), F.lit(UNTIMED)).cast("string")
    return F.coalesce(
        F.date_format("event_ts", "yyyy-MM-dd"), F.concat(F.lit("unknown-"), F.coalesce(share, F.lit("0")))
    )


def possible_replays(events: DataFrame, known: DataFrame) -> DataFrame:
    """Adds `hit`: whether the bit of an event is set in the bitmap of its date. Rows of the bitmaps are
    met by date and row, so a date with very many events is met in many places."""
    bits = known.groupBy("event_date", "row").agg(F.bitmap_or_agg("bits").alias("bits"))
    at = F.bitmap_bit_position(_place())
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.floor(byte.cast("int") / F.pow(F.lit(2), at % 8)) % 2
    return (
        events.withColumn("row", F.bitmap_bucket_number(_place()))
        .join(bits, ["event_date", "row"], "left")
        .withColumn("hit", F.coalesce(bit == 1, F.lit(False)))
        .drop("row", "bits")
    )


def follow_unique(
    events: DataFrame, root: str, checkpoint: str, *, once: bool = True
) -> StreamingQuery:
    """Store every event id once below `root`, however late it or its replay arrives.

    A replay has the time of its original, so it is looked for under its date: first in a bitmap of id
    hashes, and only where the bit is set among the stored ids of that date. A batch without
    possible replays reads no stored event. Events without a readable time are dealt by id.
    """
    spark = events.sparkSession
    stored, known = event_store(spark, root), known_store(spark, root)

    def take(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.withColumn("event_date", event_date()).select(*EVENTS.names)
        once_each = keep_newest(fresh, ["event_date", "event_id"], ["event_ts"])
        tested = materialize(possible_replays(once_each, known.read(batch_id)), "arrived")
        new = tested.where(~F.col("hit"))
        hits = tested.where("hit")
        dates = [r.event_date for r in hits.select("event_date").distinct().limit(DATES + 1).collect()]
        if dates:
            seen = stored.read(batch_id)
            if len(dates) <= DATES:
                seen = seen.where(F.col("event_date").isin(dates))
            seen = seen.select("event_date", "event_id")
            new = new.unionByName(hits.join(seen, ["event_date", "event_id"], "left_anti"))
        stored.add(new, batch_id)
        bits = once_each.groupBy("event_date", F.bitmap_bucket_number(_place()).alias("row")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(_place())).alias("bits")
        )
        known.add(bits, batch_id)

    return each_batch(events, take, checkpoint, once)


def stored_events(spark: SparkSession, root: str) -> DataFrame:
    return event_store(spark, root).read()
