"""Bronze, silver and gold data in folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators.envelope import HEALTH_SOURCE, decode, event_columns, split_decoded
from siltstone.session import scratch_path
from siltstone.storage.versions import live_path

# Partition columns are declared: inference would turn the date text into DATE.
BRONZE_SCHEMA = "value string, source string, event_date string"
PARSED_SCHEMA = f"{BRONZE_SCHEMA}, event variant"
DECODED_SCHEMA = f"{BRONZE_SCHEMA}, event variant, readable boolean"


def read_bronze(
    spark: SparkSession,
    root: str,
    source: str | None = None,
    *,
    whole_files: bool = False,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Raw JSON texts below `root/source=S/event_date=D/`.

    Every file of the folders counts, compressed ones included. By default every line is an
    event, so large files split across tasks. `whole_files` reads one event per file, for
    folders holding indented single-event files. `days` (first, last) reads only the
    partitions of those event dates.
    """
    reader = spark.read.schema(BRONZE_SCHEMA)
    raw = reader.text(root, wholetext=whole_files).select("value", "source", "event_date")
    if days is not None:
        raw = raw.where(raw.event_date.between(*days))
    return raw if source is None else raw.where(raw.source == source)


def read_loose_events(spark: SparkSession, path: str, *, whole_files: bool = True) -> DataFrame:
    """All `.json` texts, compressed or not, anywhere below `path`, whatever the folder layout."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json*")
        .text(path, wholetext=whole_files)
    )


def load_events(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decoded events, quarantined texts)."""
    return split_decoded(decode(raw))


def load_health(spark: SparkSession, bronze_root: str, *, whole_files: bool = False) -> DataFrame:
    """Decoded health events; unreadable ones have a NULL event, which names no source."""
    raw = read_bronze(spark, bronze_root, HEALTH_SOURCE, whole_files=whole_files)
    return decode(raw).select("event")


def load_payloads(
    spark: SparkSession,
    bronze_root: str,
    source: str,
    *,
    whole_files: bool = False,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Events of one source, parsed once: no filter on the parsed value, which Spark would
    evaluate a second time below the projection."""
    raw = read_bronze(spark, bronze_root, source, whole_files=whole_files, days=days)
    return event_columns(decode(raw))


def load_parsed(
    spark: SparkSession, root: str, source: str, *, days: tuple[str, str] | None = None
) -> DataFrame:
    """Events of one source from Parquet bronze (`write_parsed_bronze`), as load_payloads() gives them."""
    stored = spark.read.schema(PARSED_SCHEMA).parquet(root).where(F.col("source") == source)
    if days is not None:
        stored = stored.where(F.col("event_date").between(*days))
    return event_columns(stored.select("value", "event", "event_date"))


def split_payloads(
    spark: SparkSession,
    bronze_root: str,
    source: str,
    *,
    whole_files: bool = False,
    days: tuple[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(events of one source, value, source, event_date of the texts that are no JSON object).

    Bronze is read and parsed once: the parsed events and the other texts are written to the
    shared folder, apart by a partition column, and both results read their own part.
    """
    raw = read_bronze(spark, bronze_root, source, whole_files=whole_files, days=days)
    path = scratch_path(spark, "decoded")
    decoded = decode(raw).select(
        "value", "source", "event_date", "event", F.col("event").isNotNull().alias("readable")
    )
    decoded.write.mode("overwrite").partitionBy("readable").parquet(path)
    stored = spark.read.schema(DECODED_SCHEMA).parquet(path)
    return (
        event_columns(stored.where("readable")),
        stored.where("NOT readable").select("value", "source", "event_date"),
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A Parquet table, or None when it does not exist or holds no rows."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        found = reader.parquet(live_path(spark, path))
        if schema is not None:  # folders may add partition columns
            found = found.select(*schema.names)
        return None if found.isEmpty() else found
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_tables(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Several Parquet folders as one table; columns missing in one of them become NULL."""
    found = [table for table in (read_table(spark, path) for path in paths) if table is not None]
    if not found:
        return None
    result = found[0]
    for table in found[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
