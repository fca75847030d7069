"""Ordered work on keys too large for one task.

A window partitioned by key puts a key's whole history into one task. Keys above a row
budget are therefore cut into order-preserving segments by a range shuffle; what has to
flow from one segment to the next (a count, a sum, a last value) is first computed per
segment, carried along the segments of the key, and joined back. All other keys use the
plain window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import materialize

MAX_ROWS_PER_TASK = 20_000_000
#: Slices of a global order that any budget may ask for; more of them only with so many rows each,
#: as a task of its own costs more than the rows of a smaller one.
FEW_PIECES = 200
LEAST_ROWS_PER_PIECE = 50_000

SEGMENT = "_segment"
COPY_SALT = "_copy"
# Sums are exact, so they do not depend on how a key is cut.
EXACT = "decimal(38,9)"


@dataclass(frozen=True)
class HotKeys:
    """Keys above the row budget. At most total_rows / budget of them can exist."""

    keys: DataFrame
    rows: int


def find_hot_keys(df: DataFrame, key: str, max_rows: int) -> HotKeys | None:
    """Count rows per key (combined map-side) and keep the keys above `max_rows`."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    crowded = counted.where(F.col("_rows") > max_rows)
    total = crowded.agg(F.sum("_rows")).first()[0]
    if total is None:
        return None
    return HotKeys(materialize(crowded.select(key), "hot-keys"), int(total))


def split_hot(df: DataFrame, key: str, hot: HotKeys | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys)."""
    if hot is None:
        return df, None
    return df.join(hot.keys, key, "left_anti"), df.join(hot.keys, key, "left_semi")


def cut_into_segments(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """Number the slices of a global order; slice i holds only rows before slice i + 1.

    The range bounds come from sampling, so the numbering is written down once and every
    later use reads the same numbers.
    """
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return materialize(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments")


def salted(df: DataFrame) -> DataFrame:
    """Give identical rows distinct sort keys, so that copies can be cut apart too.

    Written down before the range shuffle: a recomputed task must see the same salt.
    """
    return materialize(df.withColumn(COPY_SALT, F.rand(7)), "salted")


def pieces_of(rows: int, max_rows: int) -> int:
    """Slices that keep most of them well below `max_rows`. A budget of a few rows does not make a
    task of each: their number stays in proportion to the rows."""
    return min(-(-rows // max_rows) * 2, max(FEW_PIECES, rows // LEAST_ROWS_PER_PIECE))


def running_history(
    points: DataFrame,
    key: str,
    order: list[str],
    value: str,
    *,
    max_rows_per_task: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add, for each row, what came before it within its key.

    `prior_count`, `prior_sum` and `prior_value` describe all earlier rows (`value` must not
    be NULL). `order` has to be total up to interchangeable rows. Sums are decimals of nine
    places, so both ways to the result give the same one.
    """
    hot = find_hot_keys(points, key, max_rows_per_task)
    ordinary, crowded = split_hot(points, key, hot)

    result = _history_within(ordinary, [key], order, value)
    if crowded is not None:
        pieces = pieces_of(hot.rows, max_rows_per_task)
        result = result.unionByName(_history_across(crowded, key, order, value, pieces))
    return result


def _history_within(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    before = (
        Window.partitionBy(*group)
        .orderBy(*[F.col(name).asc_nulls_first() for name in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return df.select(
        "*",
        F.count(value).over(before).alias("prior_count"),
        F.sum(F.col(value).cast(EXACT)).over(before).cast(EXACT).alias("prior_sum"),
        F.last(value).over(before).alias("prior_value"),
    )


def _history_across(
    df: DataFrame, key: str, order: list[str], value: str, pieces: int
) -> DataFrame:
    full_order = [*order, COPY_SALT]
    bounds = [F.col(name).asc_nulls_first() for name in (key, *full_order)]
    cut = cut_into_segments(salted(df), bounds, pieces)

    # One row per (key, segment): bounded by keys + pieces, whatever the data size.
    last = Window.partitionBy(key, SEGMENT).orderBy(
        *[F.col(name).desc_nulls_last() for name in full_order]
    )
    newest = cut.select(
        key, SEGMENT, F.col(value).alias("_v"), F.row_number().over(last).alias("_at")
    ).where("_at = 1").drop("_at")
    totals = cut.groupBy(key, SEGMENT).agg(
        F.count(value).alias("_n"), F.sum(F.col(value).cast(EXACT)).cast(EXACT).alias("_s")
    ).join(newest, [key, SEGMENT])
    earlier = (
        Window.partitionBy(key).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        key,
        SEGMENT,
        F.sum("_n").over(earlier).alias("_n"),
        F.sum("_s").over(earlier).cast(EXACT).alias("_s"),
        F.last("_v").over(earlier).alias("_v"),
    )
    local = _history_within(cut, [key, SEGMENT], full_order, value)
    joined = local.join(carry, [key, SEGMENT], "left")
    return prepend_history(joined, "_n", "_s", "_v").drop(SEGMENT, COPY_SALT)


def prepend_history(df: DataFrame, count: str, total: str, last: str) -> DataFrame:
    """Put a count, a sum and a last value before the running history of a key's rows."""
    zero = F.lit(0).cast(EXACT)
    either = F.col("prior_sum").isNotNull() | F.col(total).isNotNull()
    added = F.coalesce("prior_sum", zero) + F.coalesce(F.col(total), zero)
    return df.withColumns(
        {
            "prior_count": F.col("prior_count") + F.coalesce(F.col(count), F.lit(0)),
            "prior_sum": F.when(either, added).cast(EXACT),
            "prior_value": F.coalesce(F.col("prior_value"), F.col(last)),
        }
    ).drop(count, total, last)


def number_in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Dense 1..n numbering of a whole table in a global order, without one big task."""
    cut = cut_into_segments(df, order)
    sizes = cut.groupBy(SEGMENT).agg(F.count(F.lit(1)).alias("_n"))
    # One row per shuffle partition, so this window and the broadcast below stay small.
    ahead = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        SEGMENT, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy(SEGMENT).orderBy(*order)
    return (
        cut.join(F.broadcast(offsets), SEGMENT)
        .withColumn(name, F.row_number().over(inside) + F.col("_offset"))
        .drop(SEGMENT, "_offset")
    )
