import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators import activity, envelope, rollup, spikes
from siltstone.plans import bronze_to_silver, silver_to_gold
from siltstone.sinks.events import write_bronze
from siltstone.sources.topics import file_stream
from siltstone.streaming import activity as activity_stream
from siltstone.streaming import bronze as bronze_stream
from siltstone.streaming import rollup as rollup_stream
from siltstone.streaming.spikes import SpikeFollower
from tests.helpers import RUN_TS, dicts

KIND = ("entity_id string, metric_name string, metric_timestamp string, metric_value double, "
        "ingested_at string, source_event_id string")


def metric_event(n, minute, value):
    point = {"timestamp": f"2026-05-17T10:{minute:02d}:00Z", "value": value}
    return {"event_id": f"r{n}:E{n % 2}", "event_time": "2026-05-17T12:00:00Z", "payload": {"peakCCU": {"data": [point]}}}


def bronze(spark, root):
    documents = [("raw.island_metrics", metric_event(n, n, float(10 * n))) for n in range(6)]
    documents += [
        ("raw.shop", {"event_id": "s", "event_time": "2026-05-17", "payload": {"data": {"entries": [{"offerId": "o", "devName": "c1"}]}}}),
        ("raw.cosmetics", {"event_id": "c", "event_time": "2026-05-17", "payload": {"data": [{"id": "c1", "rarity": "epic"}]}}),
        ("raw.islands", {"event_id": "i", "event_time": "2026-05-17", "payload": {"data": {"not": "a list"}}}),
        ("ops.ingestion_status", {"source": "shop", "status": "success", "observed_at": "2026-05-17T09:00:00Z"}),
    ]
    raw = spark.createDataFrame([(t, json.dumps(d)) for t, d in documents], "topic string, value string")
    write_bronze(envelope.decode(raw), root, "2026-05-20", batch="one", topic="topic")


def test_bronze_to_gold(spark, folder):
    b, s, g = f"{folder}/b", f"{folder}/s", f"{folder}/g"
    bronze(spark, b)
    silver = {r["dataset"]: r for r in dicts(bronze_to_silver.run(spark, b, s, RUN_TS))}
    assert {k: (v["input_count"], v["output_count"], v["status"]) for k, v in silver.items()} == {
        "metric_points": (6, 6, "success"), "offers": (1, 1, "success"),
        "catalog": (1, 1, "success"), "entities": (1, 0, "no_rows")}
    gold = {r["dataset"]: r for r in dicts(silver_to_gold.run(spark, s, b, g, RUN_TS))}
    assert {k: (v["input_count"], v["output_count"]) for k, v in gold.items()} == {
        "latest_activity": (6, 2), "top_entities": (2, 2), "hourly_rollup": (6, 2),
        "spikes": (6, 4), "category_share": (1, 1), "source_health_summary": (1, 1)}
    assert silver_to_gold.succeeded(spark.createDataFrame([("latest_activity", "empty")], "dataset string, status string")) is False
    hourly = spark.read.parquet(f"{g}/hourly_rollup")
    assert "metric_date" in hourly.columns
    (only,) = dicts(bronze_to_silver.run(spark, b, s, RUN_TS, sources=["shop"], dedupe=True))
    assert only["status"] == "success"
    (skipped,) = dicts(bronze_to_silver.run(spark, f"{folder}/none", s, RUN_TS, sources=["shop"]))
    assert skipped["status"] == "skipped"
    with pytest.raises(silver_to_gold.MissingInput):
        silver_to_gold.run(spark, f"{folder}/none", b, g, RUN_TS)


def series(n=60):
    """(entity, minute, value) in time order; `hot` has half of the rows."""
    rows = []
    for i in range(n):
        rows.append(("hot", i, float(i * 37 % 50)))
        rows.append((f"e{i % 7}", i, None if i % 9 == 0 else float(i * 13 % 20)))
    return rows


def as_points(spark, rows):
    return spark.createDataFrame(
        [(e, "peakCCU", f"2026-05-17T{10 + m // 60:02d}:{m % 60:02d}:00Z", v, None, f"{n:04d}")
         for n, (e, m, v) in enumerate(rows)], KIND)


def point_stream(spark, folder, rows, chunk):
    """Files of `chunk` rows each, read one file per micro-batch."""
    for start in range(0, len(rows), chunk):
        part = as_points(spark, rows).where(
            (F.col("source_event_id").cast("int") >= start) & (F.col("source_event_id").cast("int") < start + chunk))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(KIND).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")


def spike_set(df):
    return sorted((r.entity_id, r.metric_timestamp, r.peak_ccu, r.previous_peak_ccu, round(r.rolling_avg_peak_ccu, 9)) for r in df.collect())


def test_streamed_spikes_equal_the_batch(spark, folder):
    """Six micro-batches out of order: points of the first minutes arrive last."""
    rows = series()
    late = rows[40:] + rows[:40]
    stream = point_stream(spark, folder, late, 20)
    follower = SpikeFollower(spark, f"{folder}/state", max_rows_per_task=20)
    run = follower.follow(stream, f"{folder}/progress")
    run.awaitTermination()
    assert run.lastProgress["batchId"] >= 5
    assert spike_set(follower.spikes()) == spike_set(spikes.detect_spikes(as_points(spark, late)))


def test_a_repeated_batch_changes_nothing(spark, folder):
    rows = series(20)
    follower = SpikeFollower(spark, folder)
    follower.take(as_points(spark, rows[:20]), 0)
    for _ in range(2):
        follower.take(as_points(spark, rows).where("cast(source_event_id as int) >= 20"), 1)
    assert spike_set(follower.spikes()) == spike_set(spikes.detect_spikes(as_points(spark, rows)))


def test_streamed_latest_equals_the_batch(spark, folder):
    rows = list(reversed(series(20)))
    activity_stream.follow_latest(
        point_stream(spark, folder, rows, 8), f"{folder}/latest", f"{folder}/progress"
    ).awaitTermination()
    stored = activity_stream.stored_points(spark, f"{folder}/latest")
    assert stored.count() < len(rows)
    got = dicts(activity.latest_activity(stored), "entity_id")
    assert got == dicts(activity.latest_activity(as_points(spark, rows)), "entity_id")


def test_streamed_hours_equal_the_batch(spark, folder):
    rows = series(90) + [("e1", -9 * 60, 1.0)]  # the last one is hours late
    stream = point_stream(spark, folder, rows, 40)
    rollup_stream.follow_hours(stream, f"{folder}/out", f"{folder}/progress").awaitTermination()
    got = dicts(rollup_stream.stored_hours(spark, f"{folder}/out"), "entity_id", "metric_hour")
    want = dicts(rollup.hourly_rollup(as_points(spark, rows)), "entity_id", "metric_hour")
    rounded = [[{**r, "avg_value": r["avg_value"] and round(r["avg_value"], 9)} for r in x] for x in (got, want)]
    assert rounded[0] == rounded[1]


def test_landing_and_replays(spark, folder):
    texts = [json.dumps({"event_id": f"e{i % 4}", "event_type": "shop", "event_time": "2026-05-17T10:00:00Z"}) for i in range(8)]
    rows = [("other", "k", text) for text in texts] + [("other", "k", "[]"), ("other", "k", '{"a":1}')]
    spark.createDataFrame(rows, "topic string, key string, value string").write.json(f"{folder}/in")
    stream = file_stream(spark, f"{folder}/in")
    bronze_stream.land(stream, f"{folder}/b", f"{folder}/p1", "2026-05-20", quarantine=f"{folder}/q").awaitTermination()
    assert spark.read.text(f"{folder}/b").count() == 8
    assert sorted(r.reason for r in spark.read.json(f"{folder}/q").collect()) == ["not_an_object", "unknown_source"]
    # Events without a readable time are kept once as well.
    found = bronze_stream.identified(stream)
    bronze_stream.follow_unique(found, f"{folder}/o", f"{folder}/p2").awaitTermination()
    ids = [r.event_id for r in bronze_stream.stored_events(spark, f"{folder}/o").collect()]
    assert sorted(i for i in ids if i.startswith("e")) == ["e0", "e1", "e2", "e3"] and len(ids) == 5


def test_late_replays_are_found(spark, folder):
    kind = "event_id string, key string, event_ts timestamp, value string"
    for name, day in (("a", 1), ("b", 20), ("a", 1), ("c", 2), ("b", 20)):
        spark.createDataFrame([(name, "k", dt.datetime(2026, 5, day), "v")], kind).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    for _ in range(2):
        bronze_stream.follow_unique(stream, f"{folder}/out", f"{folder}/p").awaitTermination()
    assert sorted(r.event_id for r in bronze_stream.stored_events(spark, f"{folder}/out").collect()) == ["a", "b", "c"]


def test_unreadable_texts_are_set_aside_and_days_are_pruned(spark, folder):
    b, s = f"{folder}/b", f"{folder}/s"
    bronze(spark, b)
    bad = '{"event_id": "x", "payload": NaN, "n": 1'
    row = [(bad, "shop", "2026-05-17", "two")]
    kind = "value string, source string, event_date string, batch string"
    spark.createDataFrame(row, kind).write.mode("append").partitionBy("source", "event_date", "batch").text(b)
    (shop,) = dicts(bronze_to_silver.run(spark, b, s, RUN_TS, sources=["shop"], quarantine=f"{folder}/q"))
    assert shop["status"] == "success" and shop["output_count"] == 1
    assert [r.value for r in spark.read.json(f"{folder}/q/offers").collect()] == [bad]
    (none,) = dicts(bronze_to_silver.run(spark, b, s, RUN_TS, sources=["shop"], days=("2026-05-18", "2026-05-19")))
    assert (none["input_count"], none["status"]) == (0, "empty")


def test_a_refresh_of_days_keeps_the_points_of_other_events(spark, folder):
    """Events of two days carry points of the same day."""
    def event(name, day, points):
        data = [{"timestamp": f"2026-05-{d}T10:00:00Z", "value": v} for d, v in points]
        return json.dumps({"event_id": f"{name}:{name}", "event_time": f"2026-05-{day}T12:00:00Z", "payload": {"peakCCU": {"data": data}}})

    def write(root, rows):
        kind = "value string, source string, event_date string"
        spark.createDataFrame([(text, "island_metrics", f"2026-05-{day}") for text, day in rows], kind) \
            .write.mode("overwrite").partitionBy("source", "event_date").text(root)

    def stored(root):
        return dicts(spark.read.parquet(f"{root}/metric_points").selectExpr(
            "source_event_id", "string(metric_date) AS day", "metric_value"), "source_event_id", "day")

    b, one, two = f"{folder}/b", f"{folder}/one", f"{folder}/two"
    first = [(event("a", 17, [(16, 1.0), (17, 2.0)]), 17), (event("b", 18, [(16, 3.0), (17, 4.0), (18, 5.0)]), 18)]
    write(b, first)
    bronze_to_silver.run(spark, b, one, RUN_TS, sources=["island_metrics"])
    full = stored(one)
    days, sources = ("2026-05-18", "2026-05-18"), ["island_metrics"]
    for dedupe in (False, True):
        bronze_to_silver.run(spark, b, one, RUN_TS, sources=sources, days=days, dedupe=dedupe)
        assert stored(one) == full and len(full) == 5
    # An event that came again with other points, and one that is new.
    write(b, [first[0], (event("b", 18, [(17, 6.0)]), 18), (event("c", 18, [(16, 7.0), (19, 8.0)]), 18)])
    bronze_to_silver.run(spark, b, one, RUN_TS, sources=sources, days=days)
    bronze_to_silver.run(spark, b, two, RUN_TS, sources=sources)
    assert [r for r in stored(one) if r["day"] != "2026-05-18"] == stored(two)
    for options in ({"sources": ["cosmetics"]}, {"sources": sources, "replace": "static"}, {}):
        with pytest.raises(ValueError):
            bronze_to_silver.run(spark, b, one, RUN_TS, days=days, **options)
    assert [r for r in stored(one) if r["day"] != "2026-05-18"] == stored(two)
