"""Bronze lines to silver tables as they arrive: the batch flatteners on a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.envelope import decode, event_columns
from siltstone.plans.bronze_to_silver import SilverTask, shaped
from siltstone.sources.files import BRONZE_SCHEMA


def bronze_stream(spark: SparkSession, root: str, source: str) -> DataFrame:
    raw = (
        spark.readStream.schema(BRONZE_SCHEMA)
        .text(root)
        .select("value", "source", "event_date")
    )
    return raw.where(raw.source == source)


def flatten_stream(raw: DataFrame, task: SilverTask, run_ts: dt.datetime) -> DataFrame:
    """Only projections and generators: no state, no watermark."""
    return shaped(task, event_columns(decode(raw)), run_ts)


def write_silver(
    rows: DataFrame, task: SilverTask, path: str, checkpoint: str, *, once: bool = True
) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if task.layout:
        writer = writer.partitionBy(*task.layout)
    return (writer.trigger(availableNow=True) if once else writer).start()
