"""Running a predefined query over registered views and reporting how it went."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from siltstone.plans import serving
from siltstone.sources.views import ViewRegistry


@dataclass(frozen=True)
class Answer:
    """Outcome of a query: `ok` with rows, `no_data`, or `error` with a message."""

    query_name: str
    status: str
    message: str = "OK"
    data: DataFrame | None = None

    @property
    def success(self) -> bool:
        return self.status == "ok"

    def rows(self) -> Iterator[dict]:
        """All rows, streamed: no more than a partition of them is held at a time."""
        if self.data is not None:
            for row in self.data.toLocalIterator():
                yield row.asDict()


class QueryService:
    """All serving queries. Views are refreshed when asked for, not before every query."""

    def __init__(
        self,
        views: ViewRegistry,
        *,
        today: Callable[[], dt.date] = lambda: dt.datetime.now(dt.timezone.utc).date(),
        metrics_source: str = "metrics_api",
        offers_source: str = "offers_api",
        refresh: bool = True,
    ) -> None:
        self.views = views
        self.today = today
        self.metrics_source = metrics_source
        self.offers_source = offers_source
        if refresh:
            views.refresh()

    def run(self, name: str, required: str, build: Callable[[], DataFrame]) -> Answer:
        try:
            if not self.views.exists(required):
                return Answer(name, "no_data", f"view {self.views.name(required)} is not available")
            data = build()
            if data.isEmpty():
                return Answer(name, "no_data", "no rows")
            return Answer(name, "ok", data=data)
        except PySparkException as error:
            return Answer(name, "error", f"query failed: {error}")

    def players_summary(self) -> Answer:
        return self._on_hourly("players_summary", serving.players_summary)

    def average_today(self) -> Answer:
        return self._on_hourly("average_today", serving.average_today)

    def most_active(self) -> Answer:
        return self._on_activity("most_active", serving.most_active)

    def current_ccu(self) -> Answer:
        return self._on_activity("current_ccu", serving.current_ccu)

    def top_on_day(self, limit: int = 100) -> Answer:
        return self._on_activity("top_on_day", serving.top_on_day, limit)

    def recent_spikes(self, limit: int = 10) -> Answer:
        table = self.views.table
        return self.run("recent_spikes", "spikes", lambda: serving.recent_spikes(table("spikes"), limit))

    def share_listing(self) -> Answer:
        table = self.views.table
        return self.run("share_listing", "category_share", lambda: serving.share_listing(table("category_share")))

    def offer_categories(self) -> Answer:
        table = self.views.table
        return self.run("offer_categories", "offers", lambda: serving.offer_categories(table("offers")))

    def offers_in_category(self, category: str, limit: int = 8) -> Answer:
        table = self.views.table
        return self.run(
            "offers_in_category",
            "offers",
            lambda: serving.offers_in_category(table("offers"), table("catalog"), category, limit),
        )

    def source_health(self) -> Answer:
        table = self.views.table
        return self.run(
            "source_health",
            "source_health_summary",
            lambda: serving.source_health(table("source_health_summary")),
        )

    def data_freshness(self) -> Answer:
        table = self.views.table
        return self.run(
            "data_freshness",
            "source_health_summary",
            lambda: serving.data_freshness(
                table("source_health_summary"),
                table("hourly_rollup"),
                table("latest_activity"),
                table("category_share"),
                self.today(),
                metrics_source=self.metrics_source,
                offers_source=self.offers_source,
            ),
        )

    def for_intent(self, intent: str) -> Answer | None:
        """The query a classified message asks for; None for help and unknown messages."""
        queries = {
            "current_ccu": self.most_active,
            "avg_ccu_today": self.average_today,
            "anomaly_check": self.recent_spikes,
            "shop_summary": self.offer_categories,
            "source_health": self.source_health,
            "top_islands": lambda: self.top_on_day(500),
        }
        return queries[intent]() if intent in queries else None

    def _on_hourly(self, name: str, query: Callable) -> Answer:
        return self.run(
            name, "hourly_rollup", lambda: query(self.views.table("hourly_rollup"), self.today())
        )

    def _on_activity(self, name: str, query: Callable, *args) -> Answer:
        return self.run(
            name,
            "latest_activity",
            lambda: query(self.views.table("latest_activity"), self.today(), *args),
        )
