"""Splitting a large response into numbered batches, and checking that all of them arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import variant as V

# Fixed value: records per batch unless told otherwise.
DEFAULT_BATCH = 400


def records_of(body: Column) -> Column:
    """Objects under `data`, whether it is a list or an object of records."""
    data = V.field(body, "data")
    return V.objects_in(F.coalesce(V.elements(data), F.map_values(V.members(data))))


def chunk_bodies(
    bodies: DataFrame, *, size: int = DEFAULT_BATCH, records: str = "records"
) -> DataFrame:
    """Rows (correlation_id, records array) to one row per batch of at most `size` records.

    Batches are slices of the array already in the row: nothing is shuffled, and a batch
    never exceeds `size`. Rows without records give no batch (`rejected_bodies` lists them).
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")
    total = F.size(records)
    batches = F.ceil(total / F.lit(size)).cast("int")
    numbered = bodies.where(total > 0).select(
        "*",
        total.alias("total_records"),
        batches.alias("batch_count"),
        F.explode(F.sequence(F.lit(0), batches - 1)).alias("batch_index"),
    )
    piece = F.slice(records, F.col("batch_index") * size + 1, F.lit(size))
    return numbered.withColumn(records, piece).withColumn("batch_size", F.size(records))


def rejected_bodies(bodies: DataFrame, records: str = "records") -> DataFrame:
    return bodies.where(F.coalesce(F.size(records), F.lit(0)) <= 0)


def batch_payload(records: str = "records") -> Column:
    """Payload JSON of a batch, with the numbers needed to put the batches together again."""
    return F.to_json(
        F.struct(
            F.col(records).alias("data"),
            F.struct(
                "correlation_id", "batch_index", "batch_count", "batch_size", "total_records"
            ).alias("ingestion_batch"),
        )
    )


def page_payload(records: str = "records") -> Column:
    """Payload JSON of one catalogue page: pages are batches whose total is not known."""
    return F.to_json(
        F.struct(
            F.col(records).alias("data"),
            F.struct("correlation_id", "batch_index", "batch_size").alias("ingestion_batch"),
            F.struct(
                F.col("batch_index").alias("page_index"), F.col("batch_size").alias("page_size")
            ).alias("meta"),
        )
    )


def completeness(batches: DataFrame) -> DataFrame:
    """Per correlation id: did every batch arrive, and do the sizes add up?

    A replayed batch counts once. Distinct batches are found by an aggregation that
    combines copies map-side.
    """
    distinct = batches.groupBy("correlation_id", "batch_index").agg(
        F.max("batch_count").alias("batch_count"),
        F.max("batch_size").alias("batch_size"),
        F.max("total_records").alias("total_records"),
    )
    seen = distinct.groupBy("correlation_id").agg(
        F.count(F.lit(1)).alias("batches_seen"),
        F.max("batch_count").alias("batch_count"),
        F.sum("batch_size").alias("records_seen"),
        F.max("total_records").alias("total_records"),
    )
    whole = (F.col("batches_seen") == F.col("batch_count")) & (
        F.col("records_seen") == F.col("total_records")
    )
    return seen.withColumn("is_complete", F.coalesce(whole, F.lit(False)))
