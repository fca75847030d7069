"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Every query runs in full into a no-op sink, once to warm up and then up to three times
(fewer when a query takes long); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from siltstone.checks.queries import QUERIES
from siltstone.session import build_session

HEADLINE = (
    "latest_activity_enriched",
    "top_entities",
    "top_entities_all",
    "detected_spikes",
    "hourly_rollup",
    "category_share",
    "source_health_summary",
    "players_summary",
    "most_active",
    "top_on_day",
    "average_today",
    "offer_categories",
    "offers_in_category",
    "data_freshness",
    "flatten_offers",
    "flatten_catalog",
    "flatten_entities",
    "flatten_metrics",
    "route_events",
    "chunk_records",
    "dq_rejects",
    "intent_labels",
)
RUNS = 3
ENOUGH_SECONDS = 20.0


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_seconds(spark, name: str, sf_dir: str) -> float:
    seconds(spark, name, sf_dir)
    taken: list[float] = []
    while len(taken) < RUNS and sum(taken) < ENOUGH_SECONDS:
        taken.append(seconds(spark, name, sf_dir))
    return round(statistics.median(taken), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        timings[name] = median_seconds(spark, name, sf_dir)
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
