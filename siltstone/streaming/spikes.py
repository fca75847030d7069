"""Spike detection on a stream, with the result of the batch form.

A point is judged by the count, sum and last value of all points before it. These are kept per entity
and hour. A micro-batch judges, for each entity it brings points of, that entity's points from the
hour of the earliest one on: new points in order give the current hour alone, a late one the
history since. What lies before that hour comes from the sums, so a batch reads its arrivals, the later
points of late entities, and a row per entity and earlier hour. Sums are exact decimals: it does not
matter in how many steps they came about.

An entity judged anew from an hour on takes back what was found from there on earlier: each batch
notes these starts beside its spikes, and reading applies them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltstone import schemas
from siltstone.operators.segments import (
    EXACT, MAX_ROWS_PER_TASK, prepend_history, running_history,
)
from siltstone.operators.spikes import DEFAULT_RULES, ORDER, SpikeRules, judge, primary_points
from siltstone.schemas import DEFAULT_METRICS, MetricSet
from siltstone.session import materialize
from siltstone.streaming.batches import BatchStore, each_batch

#: Buckets of entities, which are folders of the stored points and sums.
BUCKETS = 64

_STRING, _TIME, _DOUBLE = T.StringType(), T.TimestampType(), T.DoubleType()
_POINTS = T.StructType(
    [
        T.StructField("entity_id", _STRING),
        T.StructField("ts", _TIME),
        T.StructField("value", _DOUBLE),
        T.StructField("ingested_at", _STRING),
        T.StructField("source_event_id", _STRING),
        T.StructField("bucket", T.IntegerType()),
    ]
)
_LAST = T.StructType([T.StructField(name, _POINTS[name].dataType) for name in ORDER])
_HOURS = T.StructType(
    [
        T.StructField("entity_id", _STRING),
        T.StructField("hour", _TIME),
        T.StructField("points", T.LongType()),
        T.StructField("total", T.DecimalType(38, 9)),
        T.StructField("last", _LAST),
        T.StructField("bucket", T.IntegerType()),
    ]
)
#: What `judge` gives, stored as found by batch `at`; a row without a spike says that batch `at`
#: judged the entity anew from `from_ts` on.
_FOUND = [f for f in schemas.SPIKES.fields if f.name not in ("entity_id", "title", "detected_at")]
_VERDICTS = T.StructType(
    [
        T.StructField("entity_id", _STRING),
        T.StructField("at", T.LongType()),
        T.StructField("from_ts", _TIME),
        *_FOUND,
    ]
)


def hourly_sums(points: DataFrame) -> DataFrame:
    """Count, exact sum and last point of every entity and hour."""
    return points.groupBy("entity_id", "bucket", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("points"),
        F.sum(F.col("value").cast(EXACT)).cast(EXACT).alias("total"),
        F.max(F.struct(*ORDER)).alias("last"),
    )


def _added_up(sums: DataFrame, *by: str) -> DataFrame:
    return sums.groupBy(*by).agg(
        F.sum("points").alias("points"),
        F.sum("total").cast(EXACT).alias("total"),
        F.max("last").alias("last"),
    )


def valid_spikes(verdicts: DataFrame) -> DataFrame:
    """Spikes that no later batch judged anew. An entity has a start in each live folder at most."""
    starts = (
        verdicts.where(F.col("from_ts").isNotNull()).groupBy("entity_id")
        .agg(F.collect_list(F.struct("at", "from_ts")).alias("starts"))
    )

    def later(start: Column) -> Column:
        return (start["at"] > F.col("at")) & (start["from_ts"] <= F.col("metric_timestamp"))

    return verdicts.where(F.col("from_ts").isNull()).join(starts, "entity_id").where(
        ~F.exists("starts", later)
    ).drop("starts")


def _settled(verdicts: DataFrame) -> DataFrame:
    """Verdicts of adjacent batches as those of one: valid spikes, and one start per entity for the
    batches before."""
    starts = verdicts.where(F.col("from_ts").isNotNull()).groupBy("entity_id").agg(
        F.min("at").alias("at"), F.min("from_ts").alias("from_ts")
    )
    return valid_spikes(verdicts).unionByName(starts, allowMissingColumns=True)


class SpikeFollower:
    """Below `root`: points/, hours/ and verdicts/, each a store of batches."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        metrics: MetricSet = DEFAULT_METRICS,
        rules: SpikeRules = DEFAULT_RULES,
        max_rows_per_task: int = MAX_ROWS_PER_TASK,
        buckets: int = BUCKETS,
    ) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.metrics, self.rules, self.max_rows = metrics, rules, max_rows_per_task
        self.points = BatchStore(
            spark, f"{self.root}/points", _POINTS, partition_by=("bucket",), sort_by=("ts",)
        )
        self.hours = BatchStore(
            spark, f"{self.root}/hours", _HOURS, partition_by=("bucket",),
            merge=lambda sums: _added_up(sums, "entity_id", "bucket", "hour"),
        )
        self.verdicts = BatchStore(spark, f"{self.root}/verdicts", _VERDICTS, merge=_settled)

    def follow(self, points: DataFrame, checkpoint: str, *, once: bool = True) -> StreamingQuery:
        return each_batch(points, self.take, checkpoint, once)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Store the points of a batch and judge what they change."""
        bucket = F.pmod(F.xxhash64("entity_id"), F.lit(self.buckets)).cast("int")
        arrived = materialize(primary_points(batch, self.metrics).withColumn("bucket", bucket), "arrived")
        self.points.add(arrived, batch_id)
        self.hours.add(hourly_sums(arrived), batch_id)
        starts = materialize(
            arrived.groupBy("entity_id", "bucket").agg(
                F.date_trunc("hour", F.min("ts")).alias("from_ts")
            ),
            "starts",
        )
        found = judge(self._history(starts), self.rules).withColumn("from_ts", F.lit(None).cast("timestamp"))
        verdicts = found.unionByName(starts.select("entity_id", "from_ts"), allowMissingColumns=True)
        self.verdicts.add(verdicts.withColumn("at", F.lit(batch_id).cast("long")), batch_id)

    def changed_points(self, starts: DataFrame) -> DataFrame:
        """Stored points of the given entities (entity_id, bucket, from_ts) from their hour on. Folders of
        other buckets, and files that end before a bucket's earliest hour, are not read."""
        earliest = starts.groupBy("bucket").agg(F.min("from_ts").alias("from_ts")).collect()
        if not earliest:  # a row per bucket at most
            return self.points.read().where(F.lit(False))
        of_bucket = [
            (F.col("bucket") == r.bucket) & (F.col("ts") >= F.lit(r.from_ts)) for r in earliest
        ]
        stored = self.points.read().where(
            F.col("bucket").isin([r.bucket for r in earliest])
            & (F.col("ts") >= F.lit(min(r.from_ts for r in earliest)))
            & reduce(Column.__or__, of_bucket)
        )
        return (
            stored.join(starts, ["entity_id", "bucket"])
            .where(F.col("ts") >= F.col("from_ts")).drop("from_ts")
        )

    def _history(self, starts: DataFrame) -> DataFrame:
        """The running history of the changed points, from sums of the hours before them."""
        rows = running_history(
            self.changed_points(starts), "entity_id", ORDER, "value", max_rows_per_task=self.max_rows
        )
        before = self.hours.read().join(starts, ["entity_id", "bucket"]).where(
            F.col("hour") < F.col("from_ts")
        )
        carried = _added_up(before, "entity_id").select(
            "entity_id", F.col("points").alias("_n"), F.col("total").alias("_s"),
            F.col("last.value").alias("_v"),
        )
        return prepend_history(rows.join(carried, "entity_id", "left"), "_n", "_s", "_v")

    def spikes(self) -> DataFrame:
        """All spikes that the points so far give."""
        return valid_spikes(self.verdicts.read()).drop("at", "from_ts")
