"""Presentation columns: numbers, percentages, dates, truncated names, overflow counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


def number_text(value: Column, decimals: int = 0) -> Column:
    """Thousands separators. Without decimals the fraction is cut off, not rounded."""
    value = value.cast("double")
    shown = value.try_cast("bigint") if decimals == 0 else value
    return F.coalesce(F.format_number(shown, decimals), F.lit(DASH))


def percent_text(ratio: Column) -> Column:
    percent = (ratio.cast("double") * 100.0).try_cast("bigint")
    return F.coalesce(F.concat(F.format_number(percent, 0), F.lit("%")), F.lit(DASH))


def moment_text(value: Column) -> Column:
    """`dd/MM/yyyy HH:mm`; unreadable text is shown cut to 19 characters."""
    raw = F.nullif(F.trim(value.cast("string")), F.lit(""))
    parsed = F.date_format(F.try_to_timestamp(raw), "dd/MM/yyyy HH:mm")
    return F.coalesce(parsed, F.substring(raw, 1, 19), F.lit(DASH))


def shorten(value: Column, longest: int, keep: int) -> Column:
    cut = F.concat(F.substring(value, 1, keep), F.lit("..."))
    return F.when(F.length(value) > longest, cut).otherwise(value)


def overflow(total: Column, shown: int) -> Column:
    """How many rows a listing of `shown` rows leaves out."""
    return F.greatest(total - F.lit(shown), F.lit(0)).cast("bigint")


def filled_text(value: Column, default: str) -> Column:
    """Trimmed text, with blanks and NULL replaced."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))
