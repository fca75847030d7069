"""Keyword routing of free-text messages to a query."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Intents in order of precedence with the words that select them.
INTENT_WORDS = {
    "current_ccu": ("ccu", "פעילות", "שחקנים", "אונליין", "מחוברים", "activity", "players"),
    "avg_ccu_today": ("avg", "ממוצע", "היום", "today", "average"),
    "anomaly_check": ("anomaly", "חריגות", "אנומליה", "anomalies"),
    "shop_summary": ("shop", "חנות", "נדירות", "rarity", "items"),
    "source_health": ("health", "בריאות", "סטטוס", "מקורות", "status"),
    "top_islands": (
        "top islands",
        "איים מובילים",
        "איים פעילים",
        "דירוג",
        "מובילים",
        "leaderboard",
    ),
}
# Commands that always mean help.
HELP_COMMANDS = ("/help", "/start", "/menu")


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def intent(message: Column, words: dict[str, tuple[str, ...]] | None = None) -> Column:
    """First intent, in table order, one of whose words occurs in the message."""
    clean = F.lower(F.trim(F.coalesce(message, F.lit("")), F.lit(" \t\r\n\f\v")))
    label = F.when(_any([clean.startswith(command) for command in HELP_COMMANDS]), "help")
    for name, vocabulary in (words or INTENT_WORDS).items():
        label = label.when(_any([clean.contains(word) for word in vocabulary]), name)
    return label.otherwise("unknown")
