import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltstone import schemas
from siltstone.operators import activity, dedupe, health, ranking, rollup, segments, shares, spikes
from siltstone.operators.segments import number_in_order
from tests.helpers import RUN_TS, at, dicts, points

ENTITY = "entity_id string, title string, creator_code string, display_name string, ingested_at string"


def test_latest_value_per_metric_with_title(spark):
    data = points(spark, ("A", "peakCCU", at(10), 10.0), ("A", "peakCCU", at(11), 20.0),
                  ("A", "plays", at(11), 5.0))
    titles = spark.createDataFrame([("A", "Island A", "me", None, None)], ENTITY)
    (row,) = dicts(activity.latest_activity(data, titles, run_ts=RUN_TS))
    assert (row["peak_ccu"], row["plays"], row["title"]) == (20.0, 5.0, "Island A")
    assert row["unique_players"] is None and row["creator_code"] == "me"
    assert row["latest_metric_timestamp"] == dt.datetime(2026, 5, 17, 11)


def test_a_null_newest_point_does_not_hide_the_value(spark):
    (row,) = dicts(activity.latest_activity(points(
        spark, ("A", "peakCCU", at(10), 10.0), ("A", "peakCCU", at(11), None))))
    assert row["peak_ccu"] == 10.0 and row["latest_metric_timestamp"].hour == 10


def test_an_entity_without_values_is_kept(spark):
    (row,) = dicts(activity.latest_activity(points(
        spark, ("A", "peakCCU", at(10), None), ("A", "peakCCU", at(11), None),
        (None, "peakCCU", at(12), 1.0), ("A", None, at(13), 1.0), ("A", "peakCCU", "soon", 1.0))))
    assert row["peak_ccu"] is None and row["latest_metric_timestamp"].hour == 11


def test_unknown_metrics_count_for_the_time_only(spark):
    (row,) = dicts(activity.latest_activity(points(
        spark, ("A", "peakCCU", at(10), 1.0), ("A", "other", at(12), 9.0))))
    assert row["latest_metric_timestamp"].hour == 12 and row["peak_ccu"] == 1.0


def test_mixed_time_formats_are_read_one_by_one(spark):
    data = points(spark, ("A", "plays", "2026-05-17T10:00:00Z", 1.0),
                  ("A", "plays", "2026-05-17T13:00:00.123+02:00", 2.0),
                  ("A", "plays", "2026-05-17 10:30:00", 3.0))
    (row,) = dicts(activity.latest_activity(data))
    assert row["plays"] == 2.0


def test_later_ingestion_wins_a_tie(spark):
    data = spark.createDataFrame(
        [("A", "plays", at(10), 1.0, "2026-05-18T00:00:00Z", "x"),
         ("A", "plays", at(10), 2.0, "2026-05-19T00:00:00Z", "y"),
         ("A", "plays", at(10), 3.0, "2026-05-17T00:00:00Z", "z")],
        "entity_id string, metric_name string, metric_timestamp string, metric_value double, "
        "ingested_at string, source_event_id string")
    assert dicts(activity.latest_activity(data))[0]["plays"] == 2.0


def test_far_future_times_do_not_overflow_the_ordering(spark):
    data = points(spark, ("A", "plays", at(10), 1.0), ("A", "plays", "9999-12-31T23:59:59Z", 2.0),
                  ("A", "plays", "0001-01-01T00:00:00Z", 3.0))
    assert dicts(activity.latest_activity(data))[0]["plays"] == 2.0


def test_newest_dimension_record_and_title_fallback(spark):
    rows = [("A", "old", "o", "d", "2026-01-01"), ("A", None, "n", "shown", "2026-02-01"),
            ("A", "older", "x", "d", None)]
    (row,) = dicts(activity.entity_titles(spark.createDataFrame(rows, ENTITY)))
    assert row == {"entity_id": "A", "title": "shown", "creator_code": "n"}


def test_empty_inputs_keep_their_columns(spark):
    none = schemas.empty(spark, schemas.METRIC_POINTS)
    made = activity.latest_activity(none)
    assert made.count() == 0
    assert made.columns == schemas.activity_schema().names
    assert rollup.hourly_rollup(none).columns == schemas.HOURLY.names
    assert spikes.detect_spikes(none).columns == schemas.SPIKES.names
    offers = schemas.empty(spark, schemas.OFFERS)
    assert shares.category_share(offers).columns == schemas.CATEGORY_SHARE.names


def ranked(spark, count=9):
    rows = [(f"e{i:03d}", f"t{i}", float(i % 5) if i % 4 else None) for i in range(count)]
    base = spark.createDataFrame(rows, "entity_id string, title string, peak_ccu double")
    return base.withColumns({
        "unique_players": F.lit(1.0), "plays": F.lit(1.0),
        "latest_metric_timestamp": F.lit("2026-05-17").cast("timestamp"),
    })


def expected_ranks(count):
    rows = [(-(i % 5), f"e{i:03d}") for i in range(count) if i % 4]
    return [(n + 1, name) for n, (_, name) in enumerate(sorted(rows))]


@pytest.mark.parametrize("top_n", [None, 0, 3, 1000])
def test_ranking(spark, top_n):
    got = [(r["rank"], r["entity_id"]) for r in dicts(ranking.rank_entities(ranked(spark, 40), top_n=top_n), "rank")]
    want = expected_ranks(40)
    assert got == (want[:top_n] if top_n else want)


def test_large_limits_use_the_range_numbering(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LARGEST_TOP_K", 2)
    got = [(r["rank"], r["entity_id"]) for r in dicts(ranking.rank_entities(ranked(spark, 40), top_n=7), "rank")]
    assert got == expected_ranks(40)[:7]


def test_numbering_does_not_depend_on_partitions(spark):
    base = spark.range(500).withColumn("v", F.col("id") * 7919 % 503)
    for parts in (1, 7):
        numbered = number_in_order(base.repartition(parts), [F.col("v").desc()], "n")
        got = [(r.n, r.v) for r in numbered.orderBy("n").collect()]
        assert got == list(enumerate(sorted((i * 7919 % 503 for i in range(500)), reverse=True), 1))


def spike_rows(spark, values, **options):
    data = points(spark, *[("A", "peakCCU", at(10 + i), v) for i, v in enumerate(values)])
    return dicts(spikes.detect_spikes(data, run_ts=RUN_TS, **options), "metric_timestamp")


def test_spikes(spark):
    first, second = spike_rows(spark, [10.0, 20.0, 50.0])
    assert (first["peak_ccu"], first["rolling_avg_peak_ccu"], first["pct_change_from_previous"]) == (20.0, 10.0, 1.0)
    assert (second["previous_peak_ccu"], second["rolling_avg_peak_ccu"]) == (20.0, 15.0)
    assert {first["severity"], second["severity"]} == {"high"}
    assert second["anomaly_type"] == "spike_vs_rolling_avg,spike_vs_previous"


def test_spike_rules_at_their_edges(spark):
    assert spike_rows(spark, [10.0, 11.0]) == []
    assert spike_rows(spark, [10.0]) == []
    (row,) = spike_rows(spark, [10.0, 15.0])
    assert row["severity"] == "medium"
    (row,) = spike_rows(spark, [0.0, 0.0])
    assert (row["severity"], row["pct_change_from_previous"], row["anomaly_type"]) == (
        "high", None, "spike_vs_rolling_avg")
    assert spike_rows(spark, [0.0, 0.0], rules=spikes.SpikeRules(min_baseline=1.0)) == []
    (row,) = spike_rows(spark, [10.0, None, 20.0])
    assert (row["previous_peak_ccu"], row["rolling_avg_peak_ccu"]) == (10.0, 10.0)
    assert spike_rows(spark, [None, 20.0]) == []
    (row,) = spike_rows(spark, [100.0, 100.0, 10.0, 16.0])
    assert row["anomaly_type"] == "spike_vs_previous"


def brute_force(series):
    """The rules, one entity and one point at a time."""
    found = []
    for entity, values in series.items():
        seen = []
        for when, v in values:
            if v is not None and seen:
                mean, last = sum(seen) / len(seen), seen[-1]
                change = (v - last) / last if last else (1.0 if v > 0 else None)
                if v >= 1.5 * mean or (change is not None and change >= 0.5):
                    found.append((entity, when, v, last, round(mean, 9)))
            if v is not None:
                seen.append(v)
    return sorted(found)


@pytest.mark.parametrize("budget", [1000, 40, 5])
def test_hot_entities_give_the_same_spikes(spark, budget):
    """One entity holds most rows, many of them copies of one point."""
    series = {"hot": [(i, float(i * 37 % 50)) for i in range(200)], "b": [(i, float(i % 7)) for i in range(30)],
              "c": [(i, None if i % 3 else 2.0 * i) for i in range(12)]}
    series["hot"][100:100] = [(100, 9.0)] * 60
    rows = []
    for entity, values in series.items():
        for n, (minute, v) in enumerate(values):
            rows.append((entity, "peakCCU", f"2026-05-17T{minute // 60:02d}:{minute % 60:02d}:00Z", v, None, f"{n:05d}"))
    kind = ("entity_id string, metric_name string, metric_timestamp string, metric_value double, "
            "ingested_at string, source_event_id string")
    data = spark.createDataFrame(rows, kind).repartition(3)
    got = spikes.detect_spikes(data, max_rows_per_task=budget)
    found = sorted(
        (r.entity_id, r.metric_timestamp.hour * 60 + r.metric_timestamp.minute, r.peak_ccu,
         r.previous_peak_ccu, round(r.rolling_avg_peak_ccu, 9)) for r in got.collect())
    assert found == brute_force(series)


def test_identical_copies_are_cut_apart(spark):
    """Fully identical rows of one entity: every copy is judged against those before it."""
    rows = [("A", "peakCCU", at(10), 4.0)] * 50 + [("A", "peakCCU", at(11), 9.0)] * 50
    got = spikes.detect_spikes(points(spark, *rows), max_rows_per_task=10)
    means = sorted(round(r.rolling_avg_peak_ccu, 9) for r in got.collect())
    want = sorted(
        round((50 * 4.0 + k * 9.0) / (50 + k), 9) for k in range(50)
        if 9.0 >= 1.5 * (50 * 4.0 + k * 9.0) / (50 + k) or k == 0)
    assert means == want


def test_a_small_budget_does_not_make_a_task_of_every_few_rows(spark, monkeypatch):
    """4,000 rows of hot keys with a budget of 10: 800 slices were cut."""
    asked, cut = [], segments.cut_into_segments
    monkeypatch.setattr(segments, "cut_into_segments", lambda df, order, parts: asked.append(parts) or cut(df, order, 8))
    rows = spark.range(4_000).select(
        (F.col("id") % 40).cast("string").alias("k"), F.col("id").alias("at"), (F.col("id") % 97).cast("double").alias("v"))
    found = segments.running_history(rows, "k", ["at"], "v", max_rows_per_task=10)
    plain = segments.running_history(rows, "k", ["at"], "v")
    assert sorted(found.collect()) == sorted(plain.collect())
    assert asked == [200]


def test_slices_follow_the_rows():
    assert segments.pieces_of(45, 10) == 10
    assert segments.pieces_of(1_400_000, 10) == 200
    assert segments.pieces_of(10**12, 10) == 20_000_000
    assert segments.pieces_of(10**12, segments.MAX_ROWS_PER_TASK) == 100_000


def test_hourly_rollup_counts_null_points(spark):
    (row,) = dicts(rollup.hourly_rollup(points(
        spark, ("A", "peakCCU", at(10, 15), 10.0), ("A", "peakCCU", at(10, 45), None))))
    assert (row["sample_count"], row["avg_value"]) == (2, 10.0)
    assert row["metric_hour"] == "2026-05-17 10:00:00+00:00"


OFFER = "snapshot_date string, dev_name string, offer_id string"


def test_category_share(spark):
    offers = spark.createDataFrame(
        [("2026-05-17", "c1", "1"), ("2026-05-17", "c2", "2"), ("2026-05-17", None, "3"),
         ("2026-05-17", "c1", "4"), ("2026-05-16", "c1", "5")], OFFER)
    catalog = spark.createDataFrame(
        [("c1", "epic", "2"), ("c1", "old", "1"), ("c2", None, "1"), (None, "x", "1")],
        "catalog_id string, rarity string, ingested_at string")
    rows = {r["rarity"]: r for r in dicts(shares.category_share(offers, catalog))}
    assert {k: v["item_count"] for k, v in rows.items()} == {"epic": 2, "unknown": 2}
    assert sum(r["share_pct"] for r in rows.values()) == pytest.approx(100.0)
    (only,) = dicts(shares.category_share(offers))
    assert (only["rarity"], only["item_count"], only["share_pct"]) == ("unknown", 4, 100.0)


def test_share_without_any_date_uses_all_rows(spark):
    offers = spark.createDataFrame([(None, "c1", "1"), (None, "c2", "2")], OFFER)
    (row,) = dicts(shares.category_share(offers))
    assert row["item_count"] == 2 and row["snapshot_date"] is None


def test_health_summary(spark):
    kind = "source string, entity string, status string, observed_at string"
    rows = [("shop", "e", "success", at(10)), ("shop", "e", "FAILED", at(11)), ("shop", "e", "stale", "never"),
            (None, "fallback", "success", at(9)), ("", None, "success", at(9))]
    got = {r["source_name"]: r for r in dicts(health.health_summary(spark.createDataFrame(rows, kind)))}
    assert set(got) == {"shop", "fallback"}
    shop = got["shop"]
    assert (shop["success_count"], shop["failure_count"], shop["latest_status"]) == (1, 1, "failed")
    assert shop["last_success_at"].hour == 10 and got["fallback"]["last_failure_at"] is None


def test_keep_newest(spark):
    rows = [("k", "1", 5), ("k", "2", 1), ("k", "2", 3), ("j", None, 9)]
    df = spark.createDataFrame(rows, "key string, at string, v int")
    assert dicts(dedupe.keep_newest(df, ["key"], ["at"]), "key") == [
        {"key": "j", "at": None, "v": 9}, {"key": "k", "at": "2", "v": 3}]
