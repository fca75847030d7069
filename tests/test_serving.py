import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltstone.functions import display, intents
from siltstone.plans import serving
from siltstone.plans.service import QueryService
from siltstone.sources.views import ViewRegistry, dataset_paths
from tests.helpers import dicts

ACTIVITY = ("entity_id string, title string, creator_code string, latest_metric_timestamp string, "
            "peak_ccu double, unique_players double, plays double, minutes_played double")
HOURLY = ("entity_id string, metric_name string, metric_hour string, avg_value double, "
          "min_value double, max_value double, sample_count bigint")


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))

    def save(name, rows, kind):
        spark.createDataFrame(rows, kind).write.parquet(f"{root}/{name}")

    save("latest_activity", [
        ("A", "Alpha", "x", "2026-05-17T12:00:00Z", 100.0, 50.0, 10.0, 200.0),
        ("B", "Beta", "y", "2026-05-24T10:00:00Z", 80.0, 40.0, 8.0, 150.0),
        ("C", "Stale", "z", "2026-05-17T12:00:00Z", 500.0, 10.0, 1.0, 5.0)], ACTIVITY)
    save("hourly_rollup", [
        ("A", "peakCCU", "2026-05-17 12:00:00+00:00", 90.0, 80.0, 100.0, 3),
        ("B", "peakCCU", "2026-05-24 10:00:00+00:00", 40.0, 30.0, 80.0, 2),
        ("B", "uniquePlayers", "2026-05-24 10:00:00+00:00", 50.0, 40.0, 50.0, 2),
        ("B", "plays", "2026-05-24 10:00:00+00:00", 5.0, 5.0, 5.0, 1)], HOURLY)
    save("category_share", [("2026-05-17", "epic", 5, 50.0)],
         "snapshot_date string, rarity string, item_count bigint, share_pct double")
    save("spikes", [("A", "Alpha", "2026-05-17T13:00:00Z", 200.0, 80.0, "high")],
         "entity_id string, title string, metric_timestamp string, peak_ccu double, "
         "previous_peak_ccu double, severity string")
    save("source_health_summary", [("shop", "2026-05-17T12:00:00Z", None, 2, 0, "success")],
         "source_name string, last_success_at string, last_failure_at string, "
         "success_count bigint, failure_count bigint, latest_status string")
    save("offers", [
        ("2026-05-17", "o1", "d1", 900.0, "Lay"), ("2026-05-17", "o2", "d2" * 30, 900.0, " lay "),
        ("2026-05-17", "o3", "d1", None, "LAY"), ("2026-05-17", "o4", "d9", 5.0, "  "),
        ("2026-05-16", "o5", "d1", 5.0, "lay")],
        "snapshot_date string, offer_id string, dev_name string, final_price double, layout_id string")
    spark.read.parquet(f"{root}/offers").withColumn("regular_price", F.col("final_price")).write.parquet(f"{root}/offers2")
    save("catalog", [("d1", "Name", " "), ("d1", "Twin", "epic")],
         "catalog_id string, name string, rarity string")
    return root


@pytest.fixture
def service(spark, gold):
    paths = dataset_paths(gold, gold, offers=f"{gold}/offers2")
    made = QueryService(ViewRegistry(spark, paths), today=lambda: dt.date(2026, 5, 24), offers_source="shop")
    yield made
    made.views.drop()


def test_most_active_ignores_stale_days(service):
    for answer in (service.most_active(), service.current_ccu()):
        (row,) = answer.rows()
        assert answer.success and (row["entity_id"], row["peak_ccu"]) == ("B", 80.0)


def test_players_summary(service):
    (row,) = service.players_summary().rows()
    assert (row["peak_ccu_today"], row["active_players_today"], row["unique_players_today"]) == (80.0, 50.0, 50.0)
    assert (row["plays_today"], row["hours_with_data"], row["is_calendar_today"]) == (5.0, 1, True)
    assert row["metric_date"] == "2026-05-24" and row["entities_with_data"] == 1


def test_top_on_day(service):
    (row,) = service.top_on_day(5).rows()
    assert (row["rank"], row["entity_id"], row["peak_ccu"], row["total_entities"]) == (1, "B", 80.0, 1)


def test_average_today_and_later(service):
    (row,) = service.average_today().rows()
    assert (row["avg_peak_ccu"], row["period_label"]) == (40.0, "today")
    service.today = lambda: dt.date(2026, 6, 1)
    (row,) = service.average_today().rows()
    assert (row["avg_peak_ccu"], row["period_label"]) == (40.0, "latest_available")


def test_simple_listings(service):
    assert next(service.share_listing().rows())["rarity"] == "epic"
    assert next(service.source_health().rows())["source_name"] == "shop"
    spike = next(service.recent_spikes().rows())
    assert (spike["entity_id"], spike["severity"]) == ("A", "high")


def test_offer_sections(service):
    rows = list(service.offer_categories().rows())
    assert [(r["category"], r["item_count"]) for r in rows] == [
        ("LAY", 1), ("Lay", 1), ("lay", 1), ("other", 1)]
    answer = list(service.offers_in_category("LAY ", 12).rows())
    assert [r["offer_id"] for r in answer] == ["o1", "o1", "o2", "o3", "o3"]
    assert {r["total_in_category"] for r in answer} == {5}
    named = {(r["offer_id"], r["item_name"]): r["rarity"] for r in answer}
    assert named[("o1", "Name")] == "unknown" and named[("o1", "Twin")] == "epic"
    long_name = next(r["item_name"] for r in answer if r["offer_id"] == "o2")
    assert len(long_name) == 48 and long_name.endswith("...")
    assert len(list(service.offers_in_category("lay", 2).rows())) == 2
    assert service.offers_in_category("it's none").status == "no_data"


def test_freshness(service):
    (row,) = service.data_freshness().rows()
    assert row["latest_metric_date"] == "2026-05-24" and row["metric_day_is_today"] is True
    assert row["entities_on_metric_day"] == 1 and row["latest_offer_snapshot"] == "2026-05-17"
    assert row["offers_pipeline_at"].hour == 12 and row["metrics_pipeline_at"] is None


def test_outcomes(spark, service, tmp_path):
    missing = QueryService(ViewRegistry(spark, dataset_paths(str(tmp_path / "none"))))
    answer = missing.players_summary()
    assert (answer.status, answer.success, list(answer.rows())) == ("no_data", False, [])
    service.views.refresh()
    broken = service.run("broken", "spikes", lambda: spark.table("vw_spikes").select("nope"))
    assert broken.status == "error" and "nope" in broken.message


def test_second_root_is_used_when_the_first_is_unreadable(spark, gold, tmp_path):
    views = ViewRegistry(spark, dataset_paths(str(tmp_path / "none")), dataset_paths(gold))
    assert views.refresh()["spikes"].startswith(gold)
    assert views.exists("spikes")
    views.drop()
    assert not views.exists("spikes")


def test_messages_lead_to_queries(service):
    answers = {i: service.for_intent(i) for i in ("current_ccu", "top_islands", "shop_summary", "help")}
    assert answers["current_ccu"].query_name == "most_active"
    assert answers["top_islands"].query_name == "top_on_day"
    assert answers["shop_summary"].query_name == "offer_categories" and answers["help"] is None


@pytest.mark.parametrize("message, wanted", [
    ("what is the current ccu?", "current_ccu"), ("shop summary", "shop_summary"),
    ("random gibberish xyz", "unknown"), ("/help", "help"), (" /Menu now", "help"),
    ("show top islands", "top_islands"), ("מה בחנות", "shop_summary"), ("מה הפעילות", "current_ccu"),
    ("Status?", "source_health"), ("average players", "current_ccu"), ("help", "unknown"),
    ("", "unknown"), (None, "unknown"),
])
def test_intents(spark, message, wanted):
    df = spark.createDataFrame([(message,)], "m string")
    assert df.select(intents.intent(F.col("m"))).first()[0] == wanted


def test_display(spark):
    df = spark.createDataFrame(
        [(1234567.9, "2026-05-17T12:34:56Z"), (None, None), (-1500.5, "not a date at all, longer")],
        "n double, t string")
    rows = df.select(
        display.number_text(F.col("n")).alias("a"), display.number_text(F.col("n"), 2).alias("b"),
        display.percent_text(F.col("n")).alias("c"), display.moment_text(F.col("t")).alias("d"),
    ).collect()
    assert tuple(rows[0]) == ("1,234,567", "1,234,567.90", f"{int(1234567.9 * 100.0):,}%", "17/05/2026 12:34")
    assert tuple(rows[1]) == ("—", "—", "—", "—")
    assert rows[2]["a"] == "-1,500" and rows[2]["d"] == "not a date at all, "


def test_limits_are_clamped():
    assert [serving.clamp(n, 500) for n in (-1, 0, 7, 9999)] == [1, 1, 7, 500]
