"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Shuffle files go when the command that wrote them ends, not when the driver collects garbage.
FREED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # An object that repeats a key keeps the last value instead of being unreadable.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # The JVM leaves methods above 8000 bytes uncompiled. Wide JSON projections exceed that
    # as one method; below this limit Spark splits them into small ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "siltstone", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that a session made elsewhere may lack. Everything here can be
    changed at run time; instants in the tables are UTC and are read and printed as such."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the commands inside, and those from before again after them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session without the setting (unit tests) falls back to a local folder.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^]]*\])?", master):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="siltstone-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/siltstone/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The result no longer depends on upstream tasks (a lost executor costs nothing), is
    computed once however often it is used, and has known file sizes for the planner.
    """
    path = scratch_path(df.sparkSession, label)
    with settings(df.sparkSession, FREED_SHUFFLES):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
