import datetime as dt
import json

from siltstone.operators.envelope import decode, event_columns

RUN_TS = dt.datetime(2026, 5, 24, 12, tzinfo=dt.timezone.utc)
POINT = "entity_id string, metric_name string, metric_timestamp string, metric_value double"


def events(spark, *documents):
    """Documents (dict or JSON text) as decoded events."""
    texts = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return event_columns(decode(spark.createDataFrame(texts, "value string")))


def dicts(df, *order):
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [row.asDict(recursive=True) for row in rows]


def points(spark, *rows):
    return spark.createDataFrame(list(rows), POINT)


def at(hour, minute=0, day=17):
    return f"2026-05-{day:02d}T{hour:02d}:{minute:02d}:00Z"
