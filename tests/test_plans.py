"""What the physical plans must and must not contain."""

import pytest

from siltstone import schemas
from siltstone.operators import activity, envelope, flatten, ranking, rollup, shares, spikes
from siltstone.plans import serving
from siltstone.sinks.tables import write_counted
from tests.helpers import RUN_TS


def plan_of(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "5000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("silver"))
    for name, kind in (("metric_points", schemas.METRIC_POINTS), ("offers", schemas.OFFERS),
                       ("catalog", schemas.CATALOG), ("entities", schemas.ENTITIES)):
        parts = {"metric_points": ("metric_date",), "offers": ("snapshot_date",)}.get(name, ())
        row = ["2026-05-17" if f.name in parts else None for f in kind.fields]
        write_counted(spark.createDataFrame([row], kind), f"{root}/{name}", partition_by=parts)
    return lambda name, kind: spark.read.schema(kind).parquet(f"{root}/{name}")


def results(silver):
    points, entities = silver("metric_points", schemas.METRIC_POINTS), silver("entities", schemas.ENTITIES)
    offers, catalog = silver("offers", schemas.OFFERS), silver("catalog", schemas.CATALOG)
    latest = activity.latest_activity(points, entities)
    hourly = rollup.hourly_rollup(points)
    return {
        "activity": latest,
        "top": ranking.rank_entities(latest, top_n=5),
        "hourly": hourly,
        "spikes": spikes.detect_spikes(points, entities),
        "share": shares.category_share(offers, catalog),
        "players": serving.players_summary(hourly, "2026-05-17"),
        "day": serving.top_on_day(latest, "2026-05-17"),
        "section": serving.offers_in_category(offers, catalog, "x"),
    }


def test_no_python_and_no_cross_joins(silver):
    for name, df in results(silver).items():
        plan = plan_of(df)
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in plan, (name, word)


def test_limits_run_before_numbering(silver):
    made = results(silver)
    for name in ("top", "day", "section"):
        assert "TakeOrderedAndProject" in plan_of(made[name]), name


def test_filters_and_columns_reach_the_scan(silver):
    plan = plan_of(results(silver)["spikes"])
    assert "EqualTo(metric_name,peakCCU)" in plan and "IsNotNull(metric_value)" in plan
    scan = plan_of(results(silver)["hourly"]).split("ReadSchema:")[1]
    assert "source_event_id" not in scan and "interval_type" not in scan


def test_the_newest_snapshot_prunes_partitions(silver):
    plan = plan_of(results(silver)["share"])
    filters = [p.split("]")[0] for p in plan.split("PartitionFilters: [")[1:]]
    assert any("subquery" in f.lower() for f in filters)


def test_aggregates_combine_before_the_shuffle(silver):
    plan = plan_of(results(silver)["activity"])
    # One row per key and task is kept before the shuffle.
    assert "WindowGroupLimit" in plan and "Partial" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("flattener", [
    flatten.flatten_offers, flatten.flatten_catalog, flatten.flatten_entities, flatten.flatten_metrics])
def test_json_is_parsed_once_and_nothing_is_shuffled(spark, tmp_path, flattener):
    spark.createDataFrame([('{"event_id":"a"}',)], "value string").write.text(str(tmp_path / "t"))
    raw = spark.read.text(str(tmp_path / "t"))
    plan = plan_of(flattener(envelope.event_columns(envelope.decode(raw)), RUN_TS))
    assert plan.count("parseJson") == 1 and "Exchange" not in plan
