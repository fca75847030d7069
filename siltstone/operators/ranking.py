"""Ranking of entities by one measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.segments import number_in_order

# Up to here the top rows of every task fit the final merge of a top-k plan.
LARGEST_TOP_K = 100_000


def rank_entities(
    activity: DataFrame, *, by: str = "peak_ccu", top_n: int | None = None
) -> DataFrame:
    """Number rows 1..n by `by` descending, ties by entity; rows without the measure drop out.

    With a small `top_n` the limit runs first (each task keeps n rows) and only those are
    numbered; without it the global order is cut into ranges.
    """
    order = [F.col(by).desc(), F.col("entity_id").asc()]
    ranked = activity.where(F.col(by).isNotNull())
    if top_n is not None and 0 < top_n <= LARGEST_TOP_K:
        kept = ranked.orderBy(*order).limit(top_n)
        numbered = kept.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    else:
        numbered = number_in_order(ranked, order, "rank")
        if top_n is not None and top_n > 0:
            numbered = numbered.where(F.col("rank") <= top_n)
    return numbered.select(
        F.col("rank").cast("bigint").alias("rank"),
        "entity_id",
        "title",
        by,
        *[c for c in ("unique_players", "plays") if c in activity.columns],
        "latest_metric_timestamp",
    )
