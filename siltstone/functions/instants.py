"""Tolerant reading of time text. Every value is parsed on its own; bad text is NULL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOUR_TEXT = "yyyy-MM-dd HH:mm:ssxxx"


def instant(df: DataFrame, name: str) -> Column:
    """Column `name` as TIMESTAMP, whether it is stored as text or as a timestamp."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return column
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    return F.try_to_timestamp(column)


def day(df: DataFrame, name: str) -> Column:
    """Calendar day (UTC) of a time column stored as text, timestamp or date."""
    if isinstance(df.schema[name].dataType, T.DateType):
        return F.col(name)
    return instant(df, name).cast("date")


def stamp(value: dt.datetime | Column | None) -> Column:
    """One instant for a whole run; the caller injects it so that results can be repeated."""
    if isinstance(value, Column):
        return value
    if value is None:
        return F.lit(None).cast("timestamp")
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return F.lit(value.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")


def as_date(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
