"""Writing tables. Row counts come from the write itself, never from a second job."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone import schemas
from siltstone.session import FREED_SHUFFLES, settings
from siltstone.storage.versions import POINTER, Folder, VersionLog, live_path

#: Fixed value: the folder name of a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_counted(
    df: DataFrame,
    path: str,
    *,
    partition_by: tuple[str, ...] = (),
    replace: str = "dynamic",
) -> int:
    """Overwrite a Parquet table and return the rows written.

    `replace="dynamic"` replaces only the partitions present in `df`; "static" replaces the
    whole table. Rows are spread by `rebalance`, which splits an oversized partition value
    over several tasks and packs small ones together.
    """
    observed = Observation()
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows = rows.observe(observed, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", replace)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with settings(df.sparkSession, FREED_SHUFFLES):
        writer.parquet(path)
    return int(observed.get["rows"])


def write_if_any(df: DataFrame, path: str, **options) -> int:
    """Replace a table as a whole and return its rows; an empty result leaves what is there."""
    return write_version(df, path, keep_if_empty=True, **options)


def write_version(
    df: DataFrame, path: str, *, keep_if_empty: bool = False, partition_by: tuple[str, ...] = ()
) -> int:
    """Write a table as a new version: `path/version=N/`, then the pointer to it, then the version
    before goes. Whatever stops on the way, readers (`live_path`) find a whole table: the old one
    until the pointer is written, the new one from then on. Nothing is renamed but the pointer."""
    spark = df.sparkSession
    log, folder = VersionLog(spark, f"{path}/{POINTER}"), Folder(spark, path)
    now = log.newest()
    version = now["version"] + 1 if now else 1
    name = f"version={version}"
    rows = write_counted(df, f"{path}/{name}", partition_by=partition_by, replace="static")
    if rows or not keep_if_empty:
        log.append({"version": version, "folder": name})
    else:
        name = now["folder"] if now else None
        folder.delete(f"version={version}")
    if name:
        for other in folder.names():
            if other not in (name, POINTER):
                folder.delete(other)
    return rows


class Partitions:
    """A table in folders of two levels of partitions, of which a write replaces some."""

    def __init__(self, spark: SparkSession, path: str, columns: tuple[str, ...]) -> None:
        self.spark, self.path, self.columns = spark, path, columns

    def files(self) -> dict[tuple[str, ...], frozenset[str]]:
        """The files of every partition, by the values of its folders."""
        found = {}
        outer, inner = (f"{c}=" for c in self.columns)
        for one in Folder(self.spark, self.path).names():
            for two in Folder(self.spark, f"{self.path}/{one}").names() if one.startswith(outer) else []:
                if two.startswith(inner):
                    place = (one.removeprefix(outer), two.removeprefix(inner))
                    found[place] = frozenset(Folder(self.spark, f"{self.path}/{one}/{two}").names())
        return found

    @staticmethod
    def value(folder: str) -> str | None:
        return None if folder == NO_VALUE else unquote(folder)

    def replace(
        self, rows: DataFrame, owned: Callable[[tuple[str, ...]], bool] | None = None
    ) -> int:
        """Write rows over the partitions they fill, and remove the others that the write answers for:
        those `owned` points out, or else all below the outer values that were written. A run without
        rows removes nothing; a stop before the removal leaves rows that the next run removes."""
        before = self.files()
        written = write_counted(rows, self.path, partition_by=self.columns)
        if not written:
            return 0
        after = self.files()
        fresh = {place for place, names in after.items() if names != before.get(place)}
        outer = {place[0] for place in fresh}
        for place in after.keys() - fresh:
            if owned(place) if owned else place[0] in outer:
                one, two = (f"{c}={v}" for c, v in zip(self.columns, place))
                Folder(self.spark, f"{self.path}/{one}").delete(two)
        return written


def mirror(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    datasets: dict[str, tuple[T.StructType, tuple[str, ...]]],
) -> DataFrame:
    """Copy datasets, given with their schema and partition columns, to another root: the copy has
    the same partitions and types. One row per dataset: (dataset, rows)."""
    copied = [
        (
            name,
            write_counted(
                spark.read.schema(schema).parquet(live_path(spark, f"{source_root}/{name}")),
                f"{target_root}/{name}",
                partition_by=partition_by,
                replace="static",
            ),
        )
        for name, (schema, partition_by) in datasets.items()
    ]
    return spark.createDataFrame(copied, "dataset string, rows bigint")


def run_summary(spark: SparkSession, results: list[tuple]) -> DataFrame:
    """One row per dataset of a run: the list is as long as the job's task table."""
    return spark.createDataFrame(results, schemas.RUN_SUMMARY)
