"""Tables that are replaced as a whole or in part, and what a refresh reads."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siltstone.operators.envelope import decode
from siltstone.plans import bronze_to_silver, silver_to_gold
from siltstone.sinks import tables
from siltstone.sources.files import read_table, split_payloads
from siltstone.storage.versions import Folder, VersionLog, live_path
from tests.helpers import RUN_TS, dicts
from tests.test_jobs_and_streams import bronze
from tests.test_plans import plan_of


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def kept(spark, path):
    return sorted(r.n for r in read_table(spark, path).collect())


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["write_counted", "append", "delete"])
def test_a_stop_between_the_steps_leaves_a_whole_table(spark, folder, monkeypatch, step):
    path = f"{folder}/t"
    tables.write_if_any(numbers(spark, 1, 2), path)

    def stop(*_, **__):
        raise Stopped

    place = {"write_counted": tables, "append": VersionLog, "delete": Folder}[step]
    with monkeypatch.context() as patch:
        patch.setattr(place, step, stop)
        with pytest.raises(Stopped):
            tables.write_if_any(numbers(spark, 3), path)
    assert kept(spark, path) == ([3] if step == "delete" else [1, 2])
    tables.write_if_any(numbers(spark, 4), path)
    assert kept(spark, path) == [4]
    assert sorted(n for n in Folder(spark, path).names() if "version" in n) == [live_path(spark, path).split("/")[-1]]


def test_an_empty_result_leaves_the_table(spark, folder):
    path = f"{folder}/t"
    assert tables.write_if_any(numbers(spark, 1).where("n > 1"), path) == 0
    assert read_table(spark, path) is None
    tables.write_if_any(numbers(spark, 1), path)
    assert tables.write_if_any(numbers(spark, 1).where("n > 1"), path) == 0
    assert kept(spark, path) == [1]


def test_a_plain_table_becomes_a_versioned_one(spark, folder):
    path = f"{folder}/t"
    tables.write_counted(numbers(spark, 1), path)
    tables.write_if_any(numbers(spark, 2), path)
    assert kept(spark, path) == [2] and [r.n for r in spark.read.parquet(path).collect()] == [2]


def event(name, day, points):
    data = [{"timestamp": f"2026-05-{d}T10:00:00Z", "value": v} for d, v in points]
    body = {"event_id": f"{name}:{name}", "event_time": f"2026-05-{day}T12:00:00Z", "payload": {"peakCCU": {"data": data}}}
    return json.dumps(body)


def write_events(spark, root, rows):
    kind = "value string, source string, event_date string"
    spark.createDataFrame([(text, "island_metrics", f"2026-05-{day}") for text, day in rows], kind) \
        .write.mode("overwrite").partitionBy("source", "event_date").text(root)


def stored(spark, root):
    found = read_table(spark, f"{root}/metric_points").selectExpr(
        "source_event_id AS e", "string(metric_date) AS day", "string(source_day) AS at", "metric_value AS v")
    return sorted(map(tuple, found.collect()))


TASK = next(t for t in bronze_to_silver.TASKS if t.source == "island_metrics")
MAY_18 = {"sources": ["island_metrics"], "days": ("2026-05-18", "2026-05-18")}


def test_an_event_inside_and_outside_the_range_keeps_both_copies(spark, folder):
    b, s = f"{folder}/b", f"{folder}/s"
    write_events(spark, b, [(event("a", 17, [(17, 1.0)]), 17), (event("a", 17, [(17, 2.0), (16, 3.0)]), 18)])
    bronze_to_silver.run(spark, b, s, RUN_TS, sources=["island_metrics"])
    write_events(spark, b, [(event("a", 17, [(17, 1.0)]), 17), (event("a", 17, [(17, 4.0)]), 18)])
    bronze_to_silver.run(spark, b, s, RUN_TS, **MAY_18)
    assert stored(spark, s) == [("a:a", "2026-05-17", "2026-05-17", 1.0), ("a:a", "2026-05-17", "2026-05-18", 4.0)]


def test_a_refresh_reads_and_writes_its_own_partitions(spark, folder, monkeypatch):
    b, s = f"{folder}/b", f"{folder}/s"
    write_events(spark, b, [(event(f"e{d}", d, [(d, 1.0), (d - 1, 2.0)]), d) for d in range(14, 20)])
    bronze_to_silver.run(spark, b, s, RUN_TS, sources=["island_metrics"])
    table = bronze_to_silver.partitions_of(spark, TASK, f"{s}/metric_points")
    before = table.files()
    with monkeypatch.context() as patch:
        patch.setattr(bronze_to_silver, "read_table", None)  # no stored row is read
        bronze_to_silver.run(spark, b, s, RUN_TS, **MAY_18)
    after = table.files()
    changed = {place for place in after if after[place] != before[place]}
    assert changed == {("2026-05-17", "2026-05-18"), ("2026-05-18", "2026-05-18")} and after.keys() == before.keys()
    # With dedupe the touched partitions are read, by values that prune.
    found = bronze_to_silver.outside(spark, TASK, f"{s}/metric_points", {"2026-05-17", "2026-05-18"}, MAY_18["days"])
    filters = plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert "metric_date" in filters and "2026-05-17" in filters and "source_day" in filters
    assert found.count() == 2


def test_the_first_refresh_of_an_absent_table_and_one_without_rows(spark, folder):
    b, s = f"{folder}/b", f"{folder}/s"
    write_events(spark, b, [(event("a", 17, [(17, 1.0)]), 17), (event("b", 18, [(17, 2.0)]), 18)])
    for dedupe in (False, True):
        bronze_to_silver.run(spark, b, f"{s}{dedupe}", RUN_TS, dedupe=dedupe, **MAY_18)
        assert stored(spark, f"{s}{dedupe}") == [("b:b", "2026-05-17", "2026-05-18", 2.0)]
    bronze_to_silver.run(spark, b, f"{s}False", RUN_TS, sources=["island_metrics"], days=("2026-05-20", "2026-05-21"))
    assert len(stored(spark, f"{s}False")) == 1


def test_dedupe_meets_the_keys_of_other_days(spark, folder):
    b, s = f"{folder}/b", f"{folder}/s"
    write_events(spark, b, [(event("a", 17, [(17, 1.0), (16, 5.0)]), 17), (event("a", 18, [(17, 2.0)]), 18)])
    for options in ({"sources": ["island_metrics"]}, MAY_18, MAY_18):
        bronze_to_silver.run(spark, b, s, RUN_TS, dedupe=True, **options)
        assert stored(spark, s) == [("a:a", "2026-05-16", "2026-05-17", 5.0), ("a:a", "2026-05-17", "2026-05-18", 2.0)]


def test_a_full_run_drops_what_bronze_no_longer_has(spark, folder):
    b, s = f"{folder}/b", f"{folder}/s"
    write_events(spark, b, [(event("a", 17, [(16, 1.0), (17, 1.0)]), 17), (event("b", 18, [(17, 2.0)]), 18)])
    bronze_to_silver.run(spark, b, s, RUN_TS, sources=["island_metrics"])
    write_events(spark, f"{b}2", [(event("c", 19, [(17, 3.0)]), 19)])
    bronze_to_silver.run(spark, f"{b}2", s, RUN_TS, sources=["island_metrics"])
    # The day that was written holds the new rows alone, the other is as it was.
    assert [r[:2] for r in stored(spark, s)] == [("a:a", "2026-05-16"), ("c:c", "2026-05-17")]
    bronze_to_silver.run(spark, b, s, RUN_TS, sources=["island_metrics"], replace="static")
    assert len(stored(spark, s)) == 3
    bronze_to_silver.run(spark, b, s, RUN_TS, sources=["island_metrics"])
    assert len(stored(spark, s)) == 3


def test_bronze_is_scanned_once_for_both_kinds_of_texts(spark, folder, monkeypatch):
    b = f"{folder}/b"
    rows = [(event("a", 17, [(17, 1.0)]), 17), ("no json", 17), ('{"a": NaN}', 18)]
    write_events(spark, b, rows)
    events, bad = split_payloads(spark, b, "island_metrics")
    assert events.count() == 1 and bad.count() == 2
    assert b not in plan_of(events) and b not in plan_of(bad)
    (row,) = dicts(bronze_to_silver.run(
        spark, b, f"{folder}/s", RUN_TS, sources=["island_metrics"], quarantine=f"{folder}/q"))
    assert (row["input_count"], row["output_count"]) == (3, 1)
    assert {r.value for r in spark.read.json(f"{folder}/q/metric_points").collect()} == {"no json", '{"a": NaN}'}


def test_the_gold_job_counts_without_jobs_of_its_own(spark, folder, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    b, s, g = f"{folder}/b", f"{folder}/s", f"{folder}/g"
    bronze(spark, b)
    bronze_to_silver.run(spark, b, s, RUN_TS)
    with monkeypatch.context() as patch:
        patch.setattr(DataFrame, "count", None)
        summary = silver_to_gold.run(spark, s, b, g, RUN_TS)
    counts = {r["dataset"]: r["input_count"] for r in dicts(summary)}
    assert counts == {"latest_activity": 6, "top_entities": 2, "hourly_rollup": 6, "spikes": 6,
                      "category_share": 1, "source_health_summary": 1}


def test_parsed_bronze_gives_the_same_tables_from_fewer_bytes(spark, folder):
    """Texts against VARIANT columns: the same silver rows, and the scan names paths."""
    from siltstone.sinks.events import write_bronze, write_parsed_bronze
    from siltstone.sources.files import load_parsed

    entries = [{"offerId": "o1", "devName": "c"}]
    documents = [event(f"e{i}", 17, [(17, float(i))]) for i in range(50)]
    documents = [json.dumps({**json.loads(d), "event_type": "island_metrics", "note": "x" * 500}) for d in documents]
    documents += [
        json.dumps({"event_id": "s1", "event_type": "shop", "event_time": "2026-05-17", "payload": {"data": {"entries": entries}}}),
        # No list under a known name: the first one in the text counts.
        '{"event_id": "s2", "event_type": "shop", "event_time": "2026-05-17", '
        '"payload": {"data": {"zz": [{"offerId": "z"}], "aa": [{"offerId": "a"}]}}}',
        '{"event_id": "s3", "event_type": "shop"}', "no json",
    ]
    decoded = decode(spark.createDataFrame([(d,) for d in documents], "value string"))
    for write, name in ((write_bronze, "texts"), (write_parsed_bronze, "parsed")):
        for _ in range(2):  # the second write replaces the first
            write(decoded, f"{folder}/{name}", "2026-05-20", batch="one", quarantine=f"{folder}/bad-{name}")
    assert spark.read.json(f"{folder}/bad-parsed").count() == 1
    tables_of = {}
    for name, parsed in (("texts", False), ("parsed", True)):
        bronze_to_silver.run(spark, f"{folder}/{name}", f"{folder}/{name}-s", RUN_TS, sources=["shop", "island_metrics"], parsed=parsed)
        tables_of[name] = [
            sorted(map(repr, dicts(read_table(spark, f"{folder}/{name}-s/{t}").drop("ingested_at"))))
            for t in ("offers", "metric_points")
        ]
    assert tables_of["texts"] == tables_of["parsed"] and "offer_id='z'" in repr(tables_of["parsed"]).replace("'offer_id': ", "offer_id=")
    rows = load_parsed(spark, f"{folder}/parsed", "island_metrics").select("event_id")
    scan = plan_of(rows).split("ReadSchema:")[1]
    assert "event:struct<0:struct<event_id:string" in scan and "value:string" not in scan


def _texts(spark, n):
    rows = [(f'{{"event_id":"{i}","event_type":"shop","event_time":"2026-05-{i % 3 + 1:02d}T0{i % 10}:00:00Z"}}',)
            for i in range(n)]
    return decode(spark.createDataFrame(rows, "value string"))


def test_bronze_is_stored_in_waves_of_whole_folders(spark, folder, monkeypatch):
    """Slice by slice: every event once, a replay replaces its batch alone, and no stage is left."""
    from siltstone.session import shared_dir
    from siltstone.sinks import events as sinks
    from siltstone.sources.files import load_parsed, read_bronze

    monkeypatch.setattr(sinks, "WAVE_BYTES", 1)
    for write, name in ((sinks.write_bronze, "texts"), (sinks.write_parsed_bronze, "parsed")):
        root = f"{folder}/{name}"
        write(_texts(spark, 500), root, "2026-05-24", batch="other")
        write(_texts(spark, 700), root, "2026-05-24", batch="one")
        write(_texts(spark, 600), root, "2026-05-24", batch="one")
        found = load_parsed(spark, root, "shop") if name == "parsed" else read_bronze(spark, root, "shop")
        days = {r.event_date: r["count"] for r in found.groupBy("event_date").count().collect()}
        assert days == {
            f"2026-05-{d + 1:02d}": sum(n % 3 == d for n in (*range(500), *range(600))) for d in range(3)}
    stored = [path for path in Path(folder, "texts").rglob("part-*")]
    assert stored and all(path.name.endswith(".txt.gz") for path in stored)
    scratch = Path(shared_dir(spark).removeprefix("file://"), "siltstone")
    assert not list(scratch.glob("staged-*"))


def test_bronze_without_rows(spark, folder):
    from siltstone.sinks.events import write_bronze
    from siltstone.sources.files import read_bronze

    write_bronze(_texts(spark, 3).where("false"), folder, "2026-05-24", batch="one")
    assert read_bronze(spark, folder).count() == 0


def test_writes_leave_no_shuffle_files(spark, folder):
    from siltstone.session import materialize

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before, rows = shuffled(), spark.range(5000).select("id", (F.col("id") % 3).alias("p"))
    assert tables.write_counted(rows, f"{folder}/t", partition_by=("p",)) == 5000
    assert len(materialize(rows.repartition(3, "p"), "freed").collect()) == 5000
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_single_event_files_are_written_by_several_tasks(spark, folder):
    """A table of one row group is one task, which would write every file."""
    from siltstone.checks.queries import QUERIES
    from siltstone.session import shared_dir

    spark.range(1, 41).selectExpr("id AS s_suppkey", "concat('n', id) AS s_name").coalesce(1).write.parquet(
        f"{folder}/supplier.parquet")
    found = QUERIES["single_event_files"](spark, folder).collect()
    assert sorted(int(r.event_id) for r in found) == list(range(1, 41))
    assert {r.event_type for r in found} == {f"n{i}" for i in range(1, 41)}
    newest = max(Path(shared_dir(spark).removeprefix("file://"), "siltstone").glob("single-*"), key=lambda p: p.stat().st_mtime)
    files = [path.name for path in newest.rglob("part-*")]
    assert len(files) == 40
    assert len({name[:10] for name in files}) > 1
