"""Topic records: which topics to read, and reading them in bounded or streaming form.

The format is a parameter. `kafka` needs its connector on the classpath; a file source
with the columns topic, key and value behaves the same from `records` on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators.envelope import TOPIC_ENDINGS

DEFAULT_ENDING = "raw.shop"


def all_topics(prefix: str) -> list[str]:
    return [f"{prefix}.{ending}" if prefix else ending for ending in TOPIC_ENDINGS]


def resolve_topics(prefix: str = "", topic: str | None = None, full: bool = False) -> list[str]:
    """Every topic, the named one, or the default one; an unknown name is an error."""
    known = all_topics(prefix)
    if full:
        return known
    if topic:
        if topic not in known:
            raise ValueError(f"unknown topic {topic!r}, expected one of {', '.join(sorted(known))}")
        return [topic]
    return [name for name in known if name.endswith(DEFAULT_ENDING)]


def kafka_options(
    servers: str, topics: list[str], max_records: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def kafka_stream(
    spark: SparkSession, servers: str, topics: list[str], max_records: int | None = None
) -> DataFrame:
    """Stream from the earliest offset; the checkpoint of the query remembers how far it
    got, so a later drain goes on where the last one ended."""
    options = kafka_options(servers, topics, max_records)
    return records(spark.readStream.format("kafka").options(**options).load())


def file_stream(
    spark: SparkSession, path: str, *, fmt: str = "json", max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema("topic string, key string, value string").format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return records(reader.load(path))


def records(source: DataFrame) -> DataFrame:
    """(topic, key, value) as text, whatever the source stores them as."""
    return source.select(*[F.col(c).cast("string").alias(c) for c in ("topic", "key", "value")])
