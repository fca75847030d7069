import json

import pytest
from pyspark.sql import functions as F

from siltstone.functions import variant as V
from siltstone.operators import chunks, envelope, quality
from siltstone.sinks import events as sinks
from siltstone.sinks import tables
from siltstone.sources import files, topics
from tests.helpers import dicts

DAY = "2026-05-20"


def routed(spark, document, topic=None):
    text = document if isinstance(document, str) else json.dumps(document)
    raw = spark.createDataFrame([(topic, text)], "topic string, value string")
    (row,) = dicts(envelope.to_bronze(envelope.decode(raw), DAY, topic="topic").drop("event"))
    return row


@pytest.mark.parametrize("document, topic, source", [
    ({"event_id": "1"}, "any.raw.shop", "shop"),
    ({"event_id": "1"}, "raw.cosmetics", "cosmetics"),
    ({"event_id": "1", "event_type": " islands "}, "other", "islands"),
    ({"event_id": "1", "event_type": "nope", "entity": "island_metrics"}, None, "island_metrics"),
    ({"source": "s", "entity": "e", "status": "success"}, None, "ingestion_status"),
    ({"source": "s", "status": "success", "event_id": "x"}, None, None),
    ({"source": "s", "status": ""}, None, None),
    ({}, None, None),
    ("bad json", "raw.shop", "shop"),
])
def test_routing(spark, document, topic, source):
    assert routed(spark, document, topic)["source"] == source


@pytest.mark.parametrize("document, day", [
    ({"event_time": "2026-05-17T17:00:00+00:00"}, "2026-05-17"),
    ({"event_time": "", "ingested_at": "2026-05-18"}, "2026-05-18"),
    ({"event_time": "2026-13-45T00:00:00Z", "observed_at": " 2026-05-19 10:00"}, "2026-05-19"),
    ({"event_time": "20260516T120000"}, "2026-05-16"),
    ({"event_time": "tomorrow"}, DAY),
    ({}, DAY),
])
def test_event_date(spark, document, day):
    assert str(routed(spark, document)["event_date"]) == day


def test_object_key_and_stable_ids(spark):
    document = {"event_id": "abc:123", "event_type": "islands", "event_time": "2026-05-17T12:00:00+00:00"}
    row = routed(spark, document)
    assert row["object_key"] == (
        "bronze/source=islands/event_date=2026-05-17/raw_islands_20260517T120000_abc-123.json")
    health = {"source": "a", "status": "failed", "observed_at": "2026-05-17"}
    first, again = routed(spark, health), routed(spark, dict(reversed(health.items())))
    assert first["event_id"] == again["event_id"] and len(first["event_id"]) == 64


def test_envelope(spark):
    fetches = spark.createDataFrame(
        [("e", "src", "shop", 200, 42.499, "t1", '{"data":{"entries":[1,2]}}'),
         ("f", "src", "shop", 404, 1.0, "t2", '{"data":{"x":[],"y":[1,2,3],"a":[1]}}'),
         ("g", "src", "cosmetics", 299, 1.0, "t3", '{"data":{"k":{},"l":{}}}'),
         ("h", "src", "island_metrics", 500, 1.0, "t4", "{}"),
         ("i", "src", "shop", 200, 1.0, "t5", '{"data":{"featured":[],"z":[1]}}'),
         ("j", "src", "other", 200, 1.0, "t5", "{}")],
        "event_id string, source_name string, event_type string, status_code int, latency_ms double, "
        "fetched_at string, text string").withColumn("body", F.try_parse_json("text"))
    built = envelope.build_envelopes(fetches)
    assert len(built.columns) == 8
    rows = dicts(envelope.with_record_count(built).drop("payload"), "event_id")
    assert [r["record_count"] for r in rows] == [2, 1, 2, 1, 0, None]
    assert [r["request_status"] for r in rows[:4]] == ["success", "failed", "success", "failed"]
    assert (rows[0]["latency_ms"], rows[0]["event_time"]) == (42.5, "t1")


def bodies(spark, *sizes):
    rows = [(f"c{n}", list(range(size))) for n, size in enumerate(sizes)]
    return spark.createDataFrame(rows, "correlation_id string, records array<int>")


def test_chunks(spark):
    rows = dicts(chunks.chunk_bodies(bodies(spark, 5), size=2), "batch_index")
    assert [r["records"] for r in rows] == [[0, 1], [2, 3], [4]]
    assert [(r["batch_size"], r["batch_count"], r["total_records"]) for r in rows] == [(2, 3, 5), (2, 3, 5), (1, 3, 5)]
    assert chunks.chunk_bodies(bodies(spark, 5)).count() == 1
    assert chunks.chunk_bodies(bodies(spark, 0)).count() == 0
    assert chunks.rejected_bodies(bodies(spark, 0, 1)).count() == 1
    with pytest.raises(ValueError):
        chunks.chunk_bodies(bodies(spark, 1), size=0)


def test_completeness(spark):
    sent = chunks.chunk_bodies(bodies(spark, 5, 7, 1), size=2)
    lost = sent.where("not (correlation_id = 'c1' and batch_index = 1)").unionByName(sent.where("batch_index = 0"))
    got = {r["correlation_id"]: r["is_complete"] for r in dicts(chunks.completeness(lost))}
    assert got == {"c0": True, "c1": False, "c2": True}


def test_rules(spark):
    df = spark.createDataFrame(
        [(1, '{"n":100,"source":1,"entity":1,"ingested_at":1,"correlation_id":1}', "success", "2026-05-17T12:00:00+00:00", "http://h/x"),
         (2, '{"n":-1,"source":1}', "broken", "yesterday", "h/x"),
         (3, '{"n":true}', None, None, "http://"), (4, '{"n":1.5}', "stale", "2026-05-17", "http:/x y"),
         (5, '{"n":"7"}', "failed", "2026-05-17T12:00:00Z", "ftp://host")],
        "id int, json string, status string, at string, url string").withColumn("node", F.try_parse_json("json"))
    valid, rejected = quality.check(df, [
        quality.Rule("count", quality.json_non_negative_integer(V.field(F.col("node"), "n"))),
        quality.Rule("metadata", quality.has_fields(F.col("node"))),
        quality.Rule("status", quality.allowed(F.col("status"))),
        quality.Rule("time", quality.readable_time(F.col("at"))),
        quality.Rule("url", quality.full_url(F.col("url"))),
    ])
    assert [r.id for r in valid.select("id").collect()] == [1]
    reasons = {r.id: r.rejected_reasons for r in rejected.select("id", quality.REASONS).collect()}
    assert reasons[2] == ["count", "metadata", "status", "time", "url"]
    assert reasons[3] == ["count", "metadata", "status", "time", "url"]
    assert reasons[4] == ["count", "metadata", "url"] and reasons[5] == ["count", "metadata"]


def test_scalar_parsers(spark):
    df = spark.createDataFrame([(" Yes ", " 12 "), ("0", "1.5"), (None, None), ("ON", "-3"), ("x", "9" * 30)], "f string, n string")
    rows = df.select(quality.parse_flag(F.col("f")).alias("f"), quality.parse_integer(F.col("n")).alias("n")).collect()
    assert [r.f for r in rows] == [True, False, False, True, False]
    assert [r.n for r in rows] == [12, None, None, -3, None]


def test_topics():
    assert topics.resolve_topics("p") == ["p.raw.shop"]
    assert len(topics.resolve_topics("p", full=True)) == 5
    assert topics.resolve_topics("p", "p.raw.islands") == ["p.raw.islands"]
    with pytest.raises(ValueError):
        topics.resolve_topics("p", "p.raw.unknown")
    options = topics.kafka_options("host:9092", ["a", "b"], 10)
    assert options["subscribe"] == "a,b" and options["maxOffsetsPerTrigger"] == "10"


def test_topic_records_need_a_topic(spark):
    with pytest.raises(ValueError):
        sinks.topic_records(spark.range(1), "", F.col("id"))


def test_single_event_files_and_loose_folders(spark, tmp_path):
    place = tmp_path / "source=shop" / "event_date=2026-05-17"
    place.mkdir(parents=True)
    (place / "a.json").write_text(json.dumps({"event_id": "é", "payload": {}}, indent=2, ensure_ascii=False))
    (place / "b.json").write_text("bad json")
    (place / "_c.json").write_text("{}")  # unfinished files are hidden by their name
    raw = files.read_bronze(spark, str(tmp_path), "shop", whole_files=True)
    good, bad = files.load_events(raw)
    assert raw.columns == ["value", "source", "event_date"] and (good.count(), bad.count()) == (1, 1)
    assert raw.first().event_date == "2026-05-17"
    assert envelope.event_columns(good).first().event_id == "é"
    assert files.read_loose_events(spark, str(tmp_path)).count() == 2


def test_tables_that_are_missing_or_empty(spark, folder):
    assert files.read_table(spark, f"{folder}/none") is None
    spark.range(0).write.parquet(f"{folder}/empty")
    assert files.read_table(spark, f"{folder}/empty") is None
    spark.range(2).write.parquet(f"{folder}/a")
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(f"{folder}/b")
    both = files.read_tables(spark, [f"{folder}/a", f"{folder}/none", f"{folder}/b"])
    assert both.count() == 5 and both.where("x is null").count() == 2


def test_overwriting(spark, folder):
    both = spark.range(6).withColumn("p", F.col("id") % 3)
    assert tables.write_counted(both, folder + "/t", partition_by=("p",)) == 6
    one = spark.range(1).withColumn("p", F.lit(1))
    assert tables.write_counted(one, folder + "/t", partition_by=("p",)) == 1
    assert spark.read.parquet(folder + "/t").count() == 5
    assert tables.write_counted(one, folder + "/t", partition_by=("p",), replace="static") == 1
    assert spark.read.parquet(folder + "/t").count() == 1
    assert tables.write_if_any(one.limit(0), folder + "/t") == 0
    assert spark.read.parquet(folder + "/t").count() == 1


def test_compressed_bronze_is_read(spark, folder):
    rows = spark.createDataFrame([('{"a":1}', "shop", "2026-05-17")] * 3, "value string, source string, event_date string")
    rows.write.partitionBy("source", "event_date").option("compression", "gzip").text(folder + "/b")
    assert files.read_bronze(spark, folder + "/b", "shop").count() == 3


def test_the_copy_keeps_partitions_and_types(spark, folder):
    day = spark.createDataFrame([(1, "2026-05-17"), (2, "2026-05-18")], "n int, metric_date string")
    tables.write_counted(day, f"{folder}/a/t", partition_by=("metric_date",))
    copied = tables.mirror(spark, f"{folder}/a", f"{folder}/b", {"t": (day.schema, ("metric_date",))})
    assert [tuple(r) for r in copied.collect()] == [("t", 2)]
    back = spark.read.schema(day.schema).parquet(f"{folder}/b/t")
    assert sorted(map(tuple, back.collect())) == [(1, "2026-05-17"), (2, "2026-05-18")]
    assert back.where("metric_date = '2026-05-17'").count() == 1


def test_scratch_folder_must_be_shared_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from siltstone.session import shared_dir

    settings = {"spark.master": "spark://host:7077"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))
    with pytest.raises(ValueError):
        shared_dir(session)
    settings["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared_dir(session) == "hdfs:///shared"
