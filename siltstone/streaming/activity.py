"""Latest activity kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone.operators.activity import newest_points
from siltstone.streaming.batches import BatchStore, each_batch

NEWEST = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_timestamp", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("source_event_id", T.StringType()),
    ]
)


def newest_store(spark: SparkSession, root: str) -> BatchStore:
    return BatchStore(spark, root, NEWEST, merge=newest_points)


def follow_latest(
    points: DataFrame, root: str, checkpoint: str, *, once: bool = True
) -> StreamingQuery:
    """Store the newest point per entity and metric of every micro-batch below `root`.

    The newest of the newest is the newest, whatever the order of arrival: `stored_points`
    gives points that `latest_activity` takes like any others.
    """
    store = newest_store(points.sparkSession, root)

    def take(batch: DataFrame, batch_id: int) -> None:
        store.add(newest_points(batch), batch_id)

    return each_batch(points, take, checkpoint, once)


def stored_points(spark: SparkSession, root: str) -> DataFrame:
    return newest_store(spark, root).read()
