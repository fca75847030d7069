"""Share of each category in the newest snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.instants import stamp


def newest_snapshot(offers: DataFrame) -> DataFrame:
    """Rows of the highest snapshot date; all rows when no date is known.

    The date is a scalar subquery, so on a table partitioned by it only one partition is
    read.
    """
    if "snapshot_date" not in offers.columns:
        return offers
    newest = offers.agg(F.max("snapshot_date")).scalar()
    return offers.where(F.col("snapshot_date").eqNullSafe(newest))


def first_per_id(catalog: DataFrame) -> DataFrame:
    """One rarity per catalogue id: the most recently ingested record."""
    recency = [
        F.col(c).desc_nulls_last()
        for c in ("ingested_at", "source_event_id")
        if c in catalog.columns
    ]
    newest = Window.partitionBy("catalog_id").orderBy(*recency, F.col("rarity").asc_nulls_last())
    return (
        catalog.where(F.col("catalog_id").isNotNull())
        .select("catalog_id", "rarity", F.row_number().over(newest).alias("_n"))
        .where("_n = 1")
        .drop("_n")
    )


def category_share(
    offers: DataFrame,
    catalog: DataFrame | None = None,
    *,
    run_ts: dt.datetime | Column | None = None,
) -> DataFrame:
    """Offers are counted per name before the join: the join then sees one row per name,
    however often a name is offered."""
    snapshot = newest_snapshot(offers)
    dated = "snapshot_date" in offers.columns
    day = F.col("snapshot_date") if dated else F.lit(None).cast("string")
    per_name = snapshot.groupBy("dev_name", day.alias("snapshot_date")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if catalog is None:
        named = per_name.withColumn("rarity", F.lit("unknown"))
    else:
        known = first_per_id(catalog)
        named = per_name.join(known, per_name.dev_name == known.catalog_id, "left").withColumn(
            "rarity", F.coalesce("rarity", F.lit("unknown"))
        )
    counts = named.groupBy("snapshot_date", "rarity").agg(F.sum("_n").alias("item_count"))
    total = snapshot.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        "snapshot_date",
        "rarity",
        "item_count",
        (F.col("item_count") / total * 100.0).alias("share_pct"),
        stamp(run_ts).alias("updated_at"),
    )
