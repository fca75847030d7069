"""Writing raw events: bronze folders, the dated entity layout, and topic records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import variant as V
from siltstone.functions.pinned import filter_here
from siltstone.operators.envelope import OFFER_LISTS, to_bronze
from siltstone.session import FREED_SHUFFLES, scratch_path, settings
from siltstone.storage.versions import Folder

#: Folders of bronze are dealt into so many slices, each of whole folders.
SLICES = 16
#: Slices are written together up to so many bytes as they are staged.
WAVE_BYTES = 256 << 20
#: A compressed file of lines is read by one task.
LINES_PER_FILE = 100_000
_SLICE = "_slice"
#: Every task keeps a file per slice open, so rows are not sorted (and spilled) to be staged. Values
#: are staged as they are: VARIANT is shredded where it stays.
_STAGING = {
    "spark.sql.maxConcurrentOutputFileWriters": str(2 * SLICES),
    "spark.sql.variant.writeShredding.enabled": "false",
}
_STAGED_FILES = {"compression": "zstd", "parquet.block.size": str(8 << 20)}


def bronze_lines(routed: DataFrame, batch: str) -> DataFrame:
    """One JSON object per line. Line breaks outside strings are the only ones JSON allows,
    so blanking them changes nothing and keeps key order and escapes as received."""
    one_line = F.translate(F.col("value").cast("string"), "\r\n", "  ")
    return filter_here(routed, F.col("source").isNotNull()).select(
        one_line.alias("value"),
        "source",
        F.col("event_date").cast("string").alias("event_date"),
        F.lit(batch).alias("batch"),
    )


def quarantined(routed: DataFrame) -> DataFrame:
    """What could not be stored: not an object, or not attributable to a source."""
    reason = F.when(F.col("event").isNull(), "not_an_object").otherwise("unknown_source")
    return filter_here(routed, F.col("source").isNull()).select(
        F.col("value").cast("string").alias("value"), reason.alias("reason")
    )


def write_bronze(
    decoded: DataFrame,
    root: str,
    run_date: dt.date | str | Column,
    *,
    batch: str,
    topic: str | None = None,
    quarantine: str | None = None,
) -> None:
    """Store decoded events below `root/source=S/event_date=D/batch=B/`.

    Writing the same batch again replaces it, so a replay adds nothing. `rebalance` packs
    small partitions and splits a dominant (source, date) over several tasks.
    """
    routed = to_bronze(decoded, run_date, topic=topic)
    stored = {"compression": "gzip", "maxRecordsPerFile": str(LINES_PER_FILE)}
    _write_slices(bronze_lines(routed, batch), root, "text", stored)
    if quarantine:
        _replace(quarantined(routed).withColumn("batch", F.lit(batch)), ("batch",)).json(quarantine)


def write_parsed_bronze(
    decoded: DataFrame,
    root: str,
    run_date: dt.date | str | Column,
    *,
    batch: str,
    topic: str | None = None,
    quarantine: str | None = None,
) -> None:
    """Bronze as Parquet: the events as VARIANT, which Spark shreds into columns, so a flattener reads the
    paths it names and parses nothing. Folders, replays and quarantine are those of write_bronze().

    VARIANT sorts the keys of objects. The text of an event is kept beside it where their order
    matters, which is an offer event without a list under a known name.
    """
    routed = to_bronze(decoded, run_date, topic=topic)
    data = V.field(V.field(F.col("event"), "payload"), "data")
    listed = F.lit(False)
    for name in OFFER_LISTS:
        listed = listed | V.has_items(data, name)
    rows = filter_here(routed, F.col("source").isNotNull()).select(
        F.when((F.col("source") == "shop") & ~listed, F.col("value").cast("string")).alias("value"),
        "event",
        "source",
        F.col("event_date").cast("string").alias("event_date"),
        F.lit(batch).alias("batch"),
    )
    _write_slices(rows, root, "parquet", {"compression": "zstd"})
    if quarantine:
        _replace(quarantined(routed).withColumn("batch", F.lit(batch)), ("batch",)).json(quarantine)


def _write_slices(rows: DataFrame, root: str, kind: str, options: dict[str, str]) -> None:
    """Replace the (source, event_date, batch) folders that `rows` fill.

    A rebalance holds all its rows in shuffle files before the first of them is stored. So the rows
    are computed once into staged slices of whole folders, compressed and without a shuffle, and then
    rebalanced and stored some slices at a time. What is stored leaves the stage.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "staged")
    dealt = rows.withColumn(
        _SLICE, F.pmod(F.xxhash64("source", "event_date"), F.lit(SLICES)).cast("int")
    )
    with settings(spark, {**FREED_SHUFFLES, **_STAGING}):
        dealt.write.partitionBy(_SLICE).options(**_STAGED_FILES).parquet(path)
    staged, folder = spark.read.schema(dealt.schema).parquet(path), Folder(spark, path)
    for wave in _waves(folder):
        mine = staged.where(F.col(_SLICE).isin(wave)).drop(_SLICE)
        packed = mine.hint("rebalance", "source", "event_date")
        with settings(spark, FREED_SHUFFLES):
            writer = _replace(packed, ("source", "event_date", "batch"))
            writer.options(**options).format(kind).save(root)
        for number in wave:
            folder.delete(f"{_SLICE}={number}")
    parent, _, name = path.rpartition("/")
    Folder(spark, parent).delete(name)


def _waves(staged: Folder) -> list[list[int]]:
    """Numbers of the slices that are written together; one empty list if there is no row."""
    waves, room = [[]], WAVE_BYTES
    for name in sorted(n for n in staged.names() if n.startswith(f"{_SLICE}=")):
        size = staged.size(name)
        if waves[-1] and size > room:
            waves.append([])
            room = WAVE_BYTES
        waves[-1].append(int(name.removeprefix(f"{_SLICE}=")))
        room -= size
    return waves


def _replace(rows: DataFrame, partition_by: tuple[str, ...]):
    return (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
    )


def write_dated_entities(events: DataFrame, root: str, *, entity: Column, day: Column) -> None:
    """Older layout with one level per date part."""
    dated = events.select(
        "value",
        entity.alias("entity"),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    )
    levels = ("entity", "year", "month", "day")
    dated.hint("rebalance", *levels).write.mode("append").partitionBy(*levels).text(root)


def topic_records(df: DataFrame, topic: str, key: Column) -> DataFrame:
    """Rows as (topic, key, value): text key, JSON value with all columns."""
    if not topic:
        raise ValueError("a topic name is required")
    return df.select(
        F.lit(topic).alias("topic"),
        key.cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def publish(records: DataFrame, servers: str) -> None:
    """Send (topic, key, value) rows to Kafka, waiting for all replicas."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .save()
    )
