"""Named views over gold and silver folders, with a second root to fall back to."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.files import read_table

logger = logging.getLogger(__name__)

GOLD_DATASETS = (
    "latest_activity",
    "top_entities",
    "hourly_rollup",
    "spikes",
    "category_share",
    "source_health_summary",
)
SILVER_DATASETS = ("offers", "catalog")
VIEW_PREFIX = "vw_"


@dataclass
class ViewRegistry:
    """dataset -> path per root. Views are created once and refreshed on request."""

    spark: SparkSession
    primary: dict[str, str]
    fallback: dict[str, str] = field(default_factory=dict)
    allow_fallback: bool = True

    def name(self, dataset: str) -> str:
        return VIEW_PREFIX + dataset

    def exists(self, dataset: str) -> bool:
        return self.spark.catalog.tableExists(self.name(dataset))

    def table(self, dataset: str) -> DataFrame:
        return self.spark.table(self.name(dataset))

    def drop(self) -> None:
        for dataset in {*self.primary, *self.fallback, *GOLD_DATASETS, *SILVER_DATASETS}:
            self.spark.catalog.dropTempView(self.name(dataset))

    def refresh(self) -> dict[str, str]:
        """Drop all views and create them again; gives the path behind each view."""
        self.drop()
        try:
            found = self._register(self.primary)
            if found or not self.fallback or not self.allow_fallback:
                return found
            logger.warning("no dataset readable below the primary root, using the fallback")
        except PySparkException as error:
            if not self.allow_fallback:
                raise
            logger.warning("primary root failed, using the fallback: %s", error)
            self.drop()
        return self._register(self.fallback)

    def _register(self, paths: dict[str, str]) -> dict[str, str]:
        registered = {}
        for dataset, path in paths.items():
            table = read_table(self.spark, path)
            if table is None:
                logger.warning("no data for view %s at %s", self.name(dataset), path)
                continue
            table.createOrReplaceTempView(self.name(dataset))
            registered[dataset] = path
        return registered


def dataset_paths(
    gold_root: str, silver_root: str | None = None, **overrides: str
) -> dict[str, str]:
    paths = {name: f"{gold_root}/{name}" for name in GOLD_DATASETS}
    if silver_root:
        paths |= {name: f"{silver_root}/{name}" for name in SILVER_DATASETS}
    return paths | overrides
