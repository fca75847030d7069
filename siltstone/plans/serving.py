"""The predefined serving queries, as functions from gold tables to DataFrames.

`as_of` stands for "today" everywhere, so a query can be repeated and tested. Each target
day, total or maximum that belongs to the whole set is a scalar subquery over a partial
aggregation: one row, no join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.display import filled_text, number_text, overflow, shorten
from siltstone.functions.instants import as_date, day, instant
from siltstone.operators.shares import newest_snapshot
from siltstone.schemas import DEFAULT_METRICS, MetricSet

AsOf = dt.date | str


def clamp(limit: int, highest: int) -> int:
    return max(1, min(int(limit), highest))


def target_day(df: DataFrame, day_column: Column, as_of: AsOf) -> Column:
    """`as_of` if the table has rows of that day, else its latest day. One scan."""
    today = as_date(as_of)
    return df.agg(
        F.coalesce(F.max(F.when(day_column == today, day_column)), F.max(day_column))
    ).scalar()


def hourly_day(hourly: DataFrame) -> Column:
    """Day of an hourly row: the partition column if the table has one (then whole
    partitions are skipped), else parsed from the hour text."""
    if "metric_date" in hourly.columns:
        return F.col("metric_date").cast("date")
    return day(hourly, "metric_hour")


def _ordered(df: DataFrame, limit: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def players_summary(
    hourly: DataFrame,
    as_of: AsOf,
    *,
    metrics: MetricSet = DEFAULT_METRICS,
    visitors: str = "uniquePlayers",
    plays: str = "plays",
) -> DataFrame:
    target = target_day(hourly, hourly_day(hourly), as_of)
    rows = hourly.where(hourly_day(hourly) == target)
    metric, peak = F.col("metric_name"), F.col("max_value")

    per_entity = rows.where(metric.isin(visitors, plays)).groupBy("entity_id").agg(
        F.max(F.when(metric == visitors, peak)).alias("visitors"),
        F.max(F.when(metric == plays, peak)).alias("plays"),
        F.bool_or(metric == visitors).alias("visited"),
    )
    per_hour = rows.where(metric.isin(visitors, metrics.primary)).groupBy("metric_hour").agg(
        F.sum(F.when(metric == metrics.primary, peak)).alias("platform"),
        F.bool_or(metric == visitors).alias("visited"),
    )
    visited_hour = F.when(F.col("visited"), F.col("metric_hour"))
    hours = per_hour.agg(
        F.struct(
            F.coalesce(F.max("platform"), F.lit(0.0)).alias("peak"),
            F.min(visited_hour).alias("first"),
            F.max(visited_hour).alias("last"),
            F.count(visited_hour).alias("hours"),
        )
    ).scalar()
    totals = per_entity.agg(
        F.coalesce(F.sum("visitors"), F.lit(0.0)).alias("active_players_today"),
        F.coalesce(F.sum("plays"), F.lit(0.0)).alias("plays_today"),
        F.coalesce(F.count_if("visited"), F.lit(0)).alias("entities_with_data"),
    )
    return totals.select(
        target.cast("string").alias("metric_date"),
        "active_players_today",
        F.col("active_players_today").alias("unique_players_today"),
        "plays_today",
        "entities_with_data",
        hours.getField("peak").alias("peak_ccu_today"),
        hours.getField("first").alias("first_metric_hour"),
        hours.getField("last").alias("last_metric_hour"),
        hours.getField("hours").alias("hours_with_data"),
        (target == as_date(as_of)).alias("is_calendar_today"),
        hours.getField("last").alias("data_as_of"),
    )


def _on_target_day(activity: DataFrame, as_of: AsOf) -> DataFrame:
    own_day = day(activity, "latest_metric_timestamp")
    target = target_day(activity, own_day, as_of)
    found = activity.where(own_day == target)
    moment = instant(activity, "latest_metric_timestamp")
    return found.withColumns(
        {
            "metric_date": own_day,
            "is_calendar_today": own_day == as_date(as_of),
            "latest_metric_timestamp": moment,
        }
    )


def most_active(
    activity: DataFrame, as_of: AsOf, *, metrics: MetricSet = DEFAULT_METRICS
) -> DataFrame:
    """The entity leading by the primary metric on the target day."""
    by = metrics.primary_column
    rows = _on_target_day(activity, as_of).where(F.col(by).isNotNull())
    newest = rows.agg(F.max("latest_metric_timestamp")).scalar()
    top = _ordered(rows, 1, F.col(by).desc(), F.col("entity_id").asc())
    return top.select(
        "entity_id",
        "title",
        "creator_code",
        *metrics.column_names,
        "latest_metric_timestamp",
        "metric_date",
        "is_calendar_today",
        newest.alias("data_as_of"),
    )


def current_ccu(
    activity: DataFrame, as_of: AsOf, *, metrics: MetricSet = DEFAULT_METRICS
) -> DataFrame:
    """The same answer as `most_active`, under its older name."""
    return most_active(activity, as_of, metrics=metrics)


def top_on_day(
    activity: DataFrame,
    as_of: AsOf,
    limit: int = 100,
    *,
    metrics: MetricSet = DEFAULT_METRICS,
    second: str = "unique_players",
) -> DataFrame:
    """Entities of the target day by the primary metric; limit first, number afterwards."""
    rows = _on_target_day(activity, as_of)
    order = [
        F.col(metrics.primary_column).desc_nulls_last(),
        F.col(second).desc_nulls_last(),
        F.col("entity_id").asc(),
    ]
    overall = rows.agg(
        F.struct(
            F.max("latest_metric_timestamp").alias("newest"),
            F.max("metric_date").alias("day"),
            F.bool_or("is_calendar_today").alias("today"),
            F.count(F.lit(1)).alias("n"),
        )
    ).scalar()
    top = _ordered(rows, clamp(limit, 500), *order)
    return top.select(
        F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"),
        "entity_id",
        "title",
        *metrics.column_names,
        "latest_metric_timestamp",
        overall.getField("newest").alias("data_as_of"),
        overall.getField("day").alias("metric_date"),
        overall.getField("today").alias("is_calendar_today"),
        overall.getField("n").alias("total_entities"),
    )


def average_today(
    hourly: DataFrame, as_of: AsOf, *, metrics: MetricSet = DEFAULT_METRICS
) -> DataFrame:
    """Mean of the hourly averages of the primary metric, today or on the latest day."""
    primary = hourly.where(F.col("metric_name") == metrics.primary)
    own_day = hourly_day(primary)
    target = target_day(primary, own_day, as_of)
    label = F.when(target == as_date(as_of), "today").otherwise("latest_available")
    return (
        primary.where(own_day == target)
        .agg(
            F.avg("avg_value").alias("avg_peak_ccu"),
            F.count(F.lit(1)).alias("hourly_buckets"),
            F.max("metric_hour").cast("string").alias("latest_hour"),
        )
        .where(F.col("hourly_buckets") > 0)
        .withColumn("period_label", label)
    )


def recent_spikes(spikes: DataFrame, limit: int = 10) -> DataFrame:
    return _ordered(
        spikes,
        clamp(limit, 100),
        F.col("metric_timestamp").desc_nulls_last(),
        F.col("entity_id").asc(),
        F.col("peak_ccu").desc(),
        F.col("previous_peak_ccu").desc(),
    )


def share_listing(shares: DataFrame) -> DataFrame:
    return shares.orderBy(F.col("item_count").desc_nulls_last(), F.col("rarity").asc_nulls_last())


def _category(column: str = "layout_id") -> Column:
    return filled_text(F.col(column), "other")


def _latest_offers(offers: DataFrame) -> DataFrame:
    return newest_snapshot(offers).where(F.col("snapshot_date").isNotNull())


def offer_categories(offers: DataFrame) -> DataFrame:
    """Sections of the newest snapshot with their sizes."""
    return (
        _latest_offers(offers)
        .groupBy(_category().alias("category"))
        .agg(
            F.count(F.lit(1)).alias("item_count"),
            F.max("snapshot_date").alias("snapshot_date"),
        )
        .orderBy(F.col("item_count").desc(), F.col("category").asc())
    )


def offers_in_category(
    offers: DataFrame, catalog: DataFrame, category: str | None, limit: int = 8
) -> DataFrame:
    """Offers of one section, dearest first. A name listed twice in the catalogue gives two
    rows, and the total counts both."""
    wanted = (category or "other").strip()
    section = _latest_offers(offers).where(F.lower(_category()) == F.lower(F.lit(wanted)))
    known = catalog.select("catalog_id", "name", F.col("rarity").alias("_rarity"))
    joined = section.join(known, section.dev_name == known.catalog_id, "left").select(
        "offer_id",
        "dev_name",
        F.coalesce("name", shorten(F.col("dev_name"), 48, 45)).alias("item_name"),
        _category().alias("category"),
        filled_text(F.col("_rarity"), "unknown").alias("rarity"),
        "final_price",
        "regular_price",
        "snapshot_date",
    )
    return _ordered(
        joined,
        clamp(limit, 12),
        F.col("final_price").desc_nulls_last(),
        F.col("item_name").asc_nulls_last(),
        F.col("offer_id").asc_nulls_last(),
    ).withColumn("total_in_category", _joined_rows(section, known))


def _joined_rows(section: DataFrame, known: DataFrame) -> Column:
    """Size of the left join above, from counts per name on both sides: no row of a
    frequent name is shuffled for it."""
    left = section.groupBy("dev_name").agg(F.count(F.lit(1)).alias("_l"))
    right = known.groupBy("catalog_id").agg(F.count(F.lit(1)).alias("_r"))
    pairs = left.join(right, left.dev_name == right.catalog_id, "left")
    return pairs.agg(
        F.coalesce(F.sum(F.col("_l") * F.coalesce("_r", F.lit(1))), F.lit(0))
    ).scalar()


def source_health(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("source_name").asc_nulls_last())


def data_freshness(
    summary: DataFrame,
    hourly: DataFrame,
    activity: DataFrame,
    shares: DataFrame,
    as_of: AsOf,
    *,
    metrics_source: str,
    offers_source: str,
) -> DataFrame:
    """Newest times of every stage: one aggregation per table, and one more pass for the
    entities of the target day."""
    name, success = F.col("source_name"), instant(summary, "last_success_at")
    target = target_day(hourly, hourly_day(hourly), as_of)
    on_day = hourly.where(hourly_day(hourly) == target)
    newest_day = hourly.where(hourly_day(hourly) == hourly.agg(F.max(hourly_day(hourly))).scalar())
    return summary.agg(
        F.max(F.when(name == metrics_source, success)).alias("metrics_pipeline_at"),
        F.max(F.when(name == offers_source, success)).alias("offers_pipeline_at"),
    ).select(
        "*",
        newest_day.agg(F.max(instant(newest_day, "metric_hour"))).scalar().alias("latest_metric_hour"),
        activity.agg(F.max(instant(activity, "latest_metric_timestamp")))
        .scalar()
        .alias("latest_activity_at"),
        shares.agg(F.max("snapshot_date")).scalar().alias("latest_offer_snapshot"),
        target.cast("string").alias("latest_metric_date"),
        (target == as_date(as_of)).alias("metric_day_is_today"),
        on_day.agg(F.count_distinct("entity_id")).scalar().alias("entities_on_metric_day"),
    )


def section_listing(offers: DataFrame) -> DataFrame:
    """`offers_in_category` as it is displayed."""
    return listing(
        offers, SHOWN["offers_in_category"], F.col("total_in_category"),
        F.col("final_price").desc_nulls_last(), F.col("item_name").asc_nulls_last(),
        F.col("offer_id").asc_nulls_last(),
    ).select("item_name", "rarity", number_text(F.col("final_price")).alias("price"), "left_out")


def spike_listing(spikes: DataFrame) -> DataFrame:
    """`recent_spikes` as it is displayed; all spikes count for what is left out."""
    return listing(
        spikes, SHOWN["recent_spikes"], spikes.agg(F.count(F.lit(1))).scalar(),
        F.col("metric_timestamp").desc_nulls_last(), F.col("entity_id").asc(),
        F.col("peak_ccu").desc(), F.col("previous_peak_ccu").desc(),
    ).select("entity_id", "title", number_text(F.col("peak_ccu")).alias("peak"), "severity", "left_out")


def health_listing(summary: DataFrame) -> DataFrame:
    """`source_health` as it is displayed."""
    return listing(
        summary, SHOWN["source_health"], summary.agg(F.count(F.lit(1))).scalar(),
        F.col("source_name").asc_nulls_last(),
    ).select("source_name", "latest_status", "left_out")


# Rows shown per listing.
SHOWN = {"top_on_day": 25, "offers_in_category": 8, "recent_spikes": 10, "source_health": 6}


def listing(rows: DataFrame, shown: int, total: Column, *order: Column) -> DataFrame:
    """The first `shown` rows, each with the number of rows left out."""
    return _ordered(rows, shown, *order).withColumn("left_out", overflow(total, shown))


def top_listing(top: DataFrame) -> DataFrame:
    """`top_on_day` as it is displayed."""
    shown = SHOWN["top_on_day"]
    name = F.coalesce(
        F.nullif(F.col("title"), F.lit("")), F.nullif(F.col("entity_id"), F.lit("")), F.lit("?")
    )
    return listing(top, shown, F.col("total_entities"), F.col("rank").asc()).select(
        "rank",
        name.alias("name"),
        "entity_id",
        number_text(F.col("peak_ccu")).alias("peak"),
        number_text(F.col("unique_players")).alias("players"),
        "left_out",
    )
