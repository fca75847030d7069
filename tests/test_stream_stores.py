"""Levels of batch folders, their manifest, and what a micro-batch reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import spikes
from siltstone.storage.versions import Folder, VersionLog
from siltstone.streaming import bronze as bronze_stream
from siltstone.streaming import rollup as rollup_stream
from siltstone.streaming.batches import BatchStore
from siltstone.streaming.spikes import SpikeFollower
from tests.test_jobs_and_streams import as_points, series, spike_set

KIND = T.StructType([T.StructField("key", T.StringType()), T.StructField("n", T.LongType())])


def summing(spark, root, **options):
    return BatchStore(
        spark, root, KIND, merge=lambda rows: rows.groupBy("key").agg(F.sum("n").alias("n")), **options
    )


def part(spark, batch):
    return spark.createDataFrame([("all", 1), (f"k{batch % 3}", batch)], KIND).coalesce(1)


def totals(store):
    return {r.key: r.n for r in store.read().groupBy("key").agg(F.sum("n").alias("n")).collect()}


def expected(batches):
    out = {"all": batches}
    for b in range(batches):
        out[f"k{b % 3}"] = out.get(f"k{b % 3}", 0) + b
    return out


def test_fifty_batches_leave_few_folders(spark, folder):
    store = summing(spark, folder)
    for batch in range(50):
        store.add(part(spark, batch), batch)
        if batch % 10 == 0:  # stored again
            store.add(part(spark, batch), batch)
    assert len(store.parts()) <= 10 and totals(store) == expected(50)
    assert [p.first for p in store.parts()] == [0, 16, 32, 48, 49]
    # Rows of merged folders are merged; folders of no recent version are gone.
    assert store.read().count() < 50
    on_disk = [n for n in Folder(spark, folder).names() if n.startswith("batch=")]
    assert len(on_disk) <= 16
    # A batch that was merged meanwhile had been stored whole.
    store.add(part(spark, 3), 3)
    assert totals(store) == expected(50)
    assert totals_before(store, 32) == expected(32)


def totals_before(store, batch):
    return {r.key: r.n for r in store.read(batch).groupBy("key").agg(F.sum("n").alias("n")).collect()}


class Stopped(RuntimeError):
    pass


def test_a_stop_before_the_manifest_loses_nothing(spark, folder, monkeypatch):
    store = summing(spark, folder)
    for batch in range(3):
        store.add(part(spark, batch), batch)

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(VersionLog, "append", stop)
        with pytest.raises(Stopped):
            store.add(part(spark, 3), 3)
    assert totals(store) == expected(3)
    written = []
    append = VersionLog.append

    def stop_at_the_merge(log, content):
        written.append(content)
        if len(written) == 2:
            raise Stopped
        append(log, content)

    with monkeypatch.context() as patch:
        patch.setattr(VersionLog, "append", stop_at_the_merge)
        with pytest.raises(Stopped):
            store.add(part(spark, 3), 3)
    assert totals(store) == expected(4) and len(store.parts()) == 4
    store.add(part(spark, 3), 3)
    assert totals(store) == expected(4) and len(store.parts()) == 1


def test_half_a_version_does_not_count(spark, folder):
    log = VersionLog(spark, folder)
    assert log.newest() is None
    for n in range(5):
        log.append({"n": n})
    log.folder.put_text("000000000099.json", '{"n": 9')
    assert log.newest() == {"n": 4}
    assert [v["n"] for v in log.last(2)] == [4, 3]


def test_partitions_and_types_are_kept(spark, folder):
    kind = T.StructType([T.StructField("v", T.LongType()), T.StructField("day", T.StringType())])
    store = BatchStore(spark, folder, kind, partition_by=("day",), fanout=2)
    for batch in range(5):
        store.add(spark.createDataFrame([(batch, "2026-05-01"), (batch, None)], kind), batch)
    rows = store.read()
    assert rows.schema == kind and rows.count() == 10
    assert store.read().where("day = '2026-05-01'").count() == 5
    assert summing(spark, f"{folder}/none").read().count() == 0


EVENT = "event_id string, key string, event_ts timestamp, value string"


def arrivals(spark, *names):
    rows = [(n, "k", None if n[0] == "u" else dt.datetime(2026, 5, 1 + int(n[1:]) % 9), "v") for n in names]
    return spark.createDataFrame(rows, EVENT)


def follow(spark, folder, batches):
    for names in batches:
        arrivals(spark, *names).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    bronze_stream.follow_unique(stream, f"{folder}/out", f"{folder}/p").awaitTermination()
    return bronze_stream.stored_events(spark, f"{folder}/out")


def test_stored_ids_are_read_for_possible_replays_only(spark, folder, monkeypatch):
    reads = []
    read = BatchStore.read

    def noted(store, before=None):
        if store.root.endswith("/events"):
            reads.append(before)
        return read(store, before)

    monkeypatch.setattr(BatchStore, "read", noted)
    stored = follow(spark, folder, [[f"e{i}" for i in range(40)], ["e40", "e41", "u1"], ["e40", "e42"], ["u1", "u2"]])
    assert sorted(r.event_id for r in stored.collect()) == sorted([*(f"e{i}" for i in range(43)), "u1", "u2"])
    # The last read is the result's; the first two batches held no replay.
    assert reads[:-1] == [2, 3]
    untimed = {r.event_date for r in stored.where("event_id like 'u%'").collect()}
    assert all(d.startswith("unknown-") for d in untimed)


def test_a_batch_stored_in_part_is_finished_when_it_runs_again(spark, folder, monkeypatch):
    """A stop after the events and before their bitmap."""
    root = f"{folder}/out"
    for names in (["e1", "e2"], ["e3"]):
        arrivals(spark, *names).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    add = BatchStore.add

    def stop(store, rows, batch_id):
        if store.root.endswith("/known") and batch_id == 1:
            raise Stopped
        add(store, rows, batch_id)

    with monkeypatch.context() as patch:
        patch.setattr(BatchStore, "add", stop)
        with pytest.raises(Exception):
            bronze_stream.follow_unique(stream, root, f"{folder}/p").awaitTermination()
    arrivals(spark, "e3", "e4").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    bronze_stream.follow_unique(stream, root, f"{folder}/p").awaitTermination()
    assert sorted(r.event_id for r in bronze_stream.stored_events(spark, root).collect()) == ["e1", "e2", "e3", "e4"]


def test_bits_of_all_places_are_found(spark):
    events = spark.createDataFrame([(f"x{i}", "2026-05-01") for i in range(3000)], "event_id string, event_date string")
    half = events.where("pmod(xxhash64(event_id), 2) = 0")
    place = bronze_stream._place()
    known = half.groupBy("event_date", F.bitmap_bucket_number(place).alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    found = bronze_stream.possible_replays(events, known)
    assert found.where("hit").count() == found.where("hit AND pmod(xxhash64(event_id), 2) = 0").count() == half.count()


def test_a_batch_judges_what_it_changes_alone(spark, folder):
    rows = [(e, m, v) for e, m, v in series(240)]
    follower = SpikeFollower(spark, folder)
    points = as_points(spark, rows).withColumn("n", F.col("source_event_id").cast("int"))
    first, later = points.where("n < 300"), points.where("n >= 300")
    follower.take(first.drop("n"), 0)
    late = [("e1", -300, 7.0), ("e2", 500, 7.0)]
    one_more = as_points(spark, late)
    follower.take(one_more, 1)
    seen = follower.changed_points(starts_of(follower, one_more))
    by = {r.entity_id: r["count"] for r in seen.groupBy("entity_id").count().collect()}
    # A late point brings the entity's whole later history, one in order its own hour.
    whole = first.where("entity_id = 'e1' AND metric_value IS NOT NULL").count()
    assert by == {"e1": whole + 1, "e2": 1}
    follower.take(later.drop("n"), 2)
    everything = as_points(spark, rows).union(one_more)
    assert spike_set(follower.spikes()) == spike_set(spikes.detect_spikes(everything))


def starts_of(follower, batch):
    bucket = F.pmod(F.xxhash64("entity_id"), F.lit(64)).cast("int")
    points = spikes.primary_points(batch).withColumn("bucket", bucket)
    return points.groupBy("entity_id", "bucket").agg(F.date_trunc("hour", F.min("ts")).alias("from_ts"))


def test_spikes_survive_merges_of_their_folders(spark, folder):
    rows = series(40)
    follower = SpikeFollower(spark, folder)
    for store in (follower.points, follower.hours, follower.verdicts):
        store.fanout = 2
    points = as_points(spark, rows).withColumn("n", F.col("source_event_id").cast("int"))
    for batch in range(5):
        # Every fifth point: all batches but the first are late.
        follower.take(points.where(f"n % 5 = {(batch * 3) % 5}").drop("n"), batch)
    assert max(p.level for p in follower.verdicts.parts()) == 2
    assert spike_set(follower.spikes()) == spike_set(spikes.detect_spikes(as_points(spark, rows)))


def test_hours_of_many_batches_are_one_row_each(spark, folder):
    store = rollup_stream.hour_store(spark, folder)
    one = spark.createDataFrame([("e", "m", "h", 1.5, 1, 1.5, 1.5, 1)], rollup_stream.PARTS)
    for batch in range(4):
        store.add(one, batch)
    assert [tuple(r) for r in store.read().collect()] == [("e", "m", "h", 6.0, 4, 1.5, 1.5, 4)]
