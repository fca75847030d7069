"""Bronze events to silver tables, one task per source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone.operators import flatten
from siltstone.operators.dedupe import keep_newest
from siltstone.session import materialize
from siltstone.sinks.tables import Partitions, run_summary, write_if_any
from siltstone.sources.files import load_parsed, load_payloads, read_table, split_payloads
from siltstone.storage.versions import live_path


@dataclass(frozen=True)
class SilverTask:
    source: str
    dataset: str
    transform: Callable[[DataFrame, dt.datetime], DataFrame]
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()

    @property
    def layout(self) -> tuple[str, ...]:
        """Partition columns of the stored table: its own, then the bronze day of the rows."""
        return (*self.partition_by, flatten.SOURCE_DAY) if self.partition_by else ()

    @property
    def stored_schema(self) -> T.StructType:
        day = [T.StructField(flatten.SOURCE_DAY, T.StringType())] if self.partition_by else []
        return T.StructType([*self.schema.fields, *day])


TASKS = (
    SilverTask("shop", "offers", flatten.flatten_offers, schemas.OFFERS, ("snapshot_date",),
               ("snapshot_date", "offer_id")),
    SilverTask("cosmetics", "catalog", flatten.flatten_catalog, schemas.CATALOG, (),
               ("catalog_id",)),
    SilverTask("islands", "entities", flatten.flatten_entities, schemas.ENTITIES, (),
               ("entity_id",)),
    SilverTask("island_metrics", "metric_points", flatten.flatten_metrics, schemas.METRIC_POINTS,
               ("metric_date",), ("entity_id", "metric_name", "metric_timestamp")),
)


def run_task(
    spark: SparkSession,
    task: SilverTask,
    bronze_root: str,
    silver_root: str,
    run_ts: dt.datetime,
    *,
    replace: str = "dynamic",
    dedupe: bool = False,
    whole_files: bool = False,
    days: tuple[str, str] | None = None,
    quarantine: str | None = None,
    parsed: bool = False,
) -> tuple[str, int, int, str, str]:
    """One row of the run summary. `replace="static"` rewrites the table as a whole; `days`
    (first, last) reads those event dates alone and replaces what is stored of them, see
    refresh(); unreadable texts go to `quarantine`; `parsed` reads Parquet bronze, which has none."""
    check_days(task, replace, days)
    target = f"{silver_root}/{task.dataset}"
    where = {"whole_files": whole_files, "days": days}
    try:
        if parsed:
            events = load_parsed(spark, bronze_root, task.source, days=days)
        elif quarantine is None:
            events = load_payloads(spark, bronze_root, task.source, **where)
        else:
            events, bad = split_payloads(spark, bronze_root, task.source, **where)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return task.dataset, 0, 0, target, "skipped"

    # One pass: the write counts the events it reads and the rows it writes, and a run without
    # rows leaves the stored table as it is.
    seen = Observation()
    counted = events.observe(seen, F.count(F.lit(1)).alias("events"))
    rows = shaped(task, counted, run_ts, dedupe)
    if not task.partition_by or replace != "dynamic":
        written = write_if_any(rows, target, partition_by=task.layout)
    elif days is None:
        written = partitions_of(spark, task, target).replace(rows)
    else:
        written = refresh(spark, rows, task, target, days, dedupe)
    found = int(seen.get["events"])
    if quarantine is not None and not parsed:
        found += set_aside(bad, f"{quarantine}/{task.dataset}")
    status = "success" if written else "no_rows" if found else "empty"
    return task.dataset, found, written, target, status


def set_aside(bad: DataFrame, path: str) -> int:
    """Write unreadable texts and return how many there are."""
    counted = Observation()
    rows = bad.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").json(path)
    return int(counted.get["rows"])


def check_days(task: SilverTask, replace: str, days: tuple[str, str] | None) -> None:
    if days is not None and (not task.partition_by or replace != "dynamic"):
        raise ValueError(
            f"days would replace all of {task.dataset} with the rows of some days: "
            "it takes a partitioned table and replace='dynamic'"
        )


def partitions_of(spark: SparkSession, task: SilverTask, target: str) -> Partitions:
    return Partitions(spark, live_path(spark, target), task.layout)


def refresh(
    spark: SparkSession, rows: DataFrame, task: SilverTask, target: str, days: tuple[str, str],
    dedupe: bool,
) -> int:
    """Replace what is stored of a range of bronze days by the rows of those days.

    A row's own day is not its event's day, but both are partitions: the rows of the range lie in folders of
    their own. Those folders are replaced and those that the range no longer fills go; no stored row
    is read. An event that is stored under days inside and outside the range keeps the rows of
    both. With `dedupe` keys may meet those of other days, so the partitions that the range touches
    are read, and only these.
    """
    (key,) = task.partition_by
    table = partitions_of(spark, task, target)

    def of_range(place: tuple[str, ...]) -> bool:
        return days[0] <= place[1] <= days[1]

    rows = materialize(rows, "refresh")
    if not dedupe:
        return table.replace(rows, of_range)
    # An empty partition value is stored as a null. Days are as many as partitions.
    new = {r[0] for r in rows.select(F.nullif(key, F.lit(""))).distinct().collect()}
    touched = new | {table.value(place[0]) for place in table.files() if of_range(place)}
    kept = outside(spark, task, target, touched, days)
    if kept is None:
        return table.replace(rows, of_range)
    merged = keep_newest(
        rows.unionByName(kept), list(task.keys), ["ingested_at", "source_event_id"]
    )
    # Written before the partitions it reads are replaced.
    return table.replace(
        materialize(merged, "refreshed"), lambda place: table.value(place[0]) in touched
    )


def outside(
    spark: SparkSession, task: SilverTask, target: str, touched: set[str | None], days: tuple[str, str]
) -> DataFrame | None:
    """Stored rows of the given partitions that are not of the given bronze days. The values are in the
    filter, so that no other partition is read."""
    (key,) = task.partition_by
    stored = read_table(spark, target, task.stored_schema)
    if stored is None:
        return None
    place = F.col(key).isin(sorted(v for v in touched if v is not None))
    if None in touched:
        place = place | F.col(key).isNull()
    inside = F.coalesce(F.col(flatten.SOURCE_DAY).between(*days), F.lit(False))
    return stored.where(place & ~inside)


def shaped(
    task: SilverTask, events: DataFrame, run_ts: dt.datetime, dedupe: bool = False
) -> DataFrame:
    """Rows of a silver table; those of a partitioned one with the bronze day they come from."""
    rows = task.transform(events, run_ts)
    if task.partition_by and flatten.SOURCE_DAY not in rows.columns:
        rows = rows.withColumn(flatten.SOURCE_DAY, F.lit(None).cast("string"))
    rows = rows.select(*task.stored_schema.names)
    if dedupe:
        rows = keep_newest(rows, list(task.keys), ["ingested_at", "source_event_id"])
    return rows


def run(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    run_ts: dt.datetime,
    *,
    sources: list[str] | None = None,
    **options,
) -> DataFrame:
    """Run all tasks, or those of `sources`; the summary has one row per task."""
    wanted = {name.strip() for name in sources} if sources else None
    tasks = [task for task in TASKS if wanted is None or task.source in wanted]
    for task in tasks:
        check_days(task, options.get("replace", "dynamic"), options.get("days"))
    results = [
        run_task(spark, task, bronze_root, silver_root, run_ts, **options) for task in tasks
    ]
    return run_summary(spark, results)
