"""Data-quality rules: each is a named condition, and rows carry the names they fail."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions import variant as V
from siltstone.functions.pinned import filter_here

# Fixed values.
ALLOWED_STATUS = ("success", "failed", "stale")
REQUIRED_METADATA = ("source", "entity", "ingested_at", "correlation_id")
TRUE_WORDS = ("1", "true", "yes", "on")

REASONS = "rejected_reasons"


@dataclass(frozen=True)
class Rule:
    name: str
    holds: Column


def non_negative_integer(value: Column) -> Column:
    """Typed integer columns: not negative."""
    return value >= 0


def json_non_negative_integer(node: Column) -> Column:
    """A JSON number without fraction, not a boolean and not text, at least 0."""
    return (F.schema_of_variant(node) == "BIGINT") & (
        F.try_variant_get(node, "$", "bigint") >= 0
    )


def missing_fields(node: Column, required: tuple[str, ...] = REQUIRED_METADATA) -> Column:
    """Names from `required` that are not keys of the object, sorted."""
    keys = F.map_keys(V.members(node))
    names = F.array(*[F.lit(name) for name in sorted(required)])
    return F.array_except(names, F.coalesce(keys, F.array().cast("array<string>")))


def has_fields(node: Column, required: tuple[str, ...] = REQUIRED_METADATA) -> Column:
    return F.size(missing_fields(node, required)) == 0


def allowed(value: Column, values: tuple[str, ...] = ALLOWED_STATUS) -> Column:
    return value.isin(*values)


def readable_time(value: Column) -> Column:
    return F.try_to_timestamp(value).isNotNull()


def full_url(value: Column) -> Column:
    """Scheme and host are both there."""
    scheme = F.try_parse_url(value, F.lit("PROTOCOL"))
    host = F.try_parse_url(value, F.lit("HOST"))
    return scheme.isNotNull() & host.isNotNull()


def parse_flag(value: Column, default: bool = False) -> Column:
    words = F.lower(F.trim(value, F.lit(" \t\r\n"))).isin(*TRUE_WORDS)
    return F.when(value.isNull(), F.lit(default)).otherwise(words)


def parse_integer(value: Column) -> Column:
    """Whole-number text as bigint, NULL otherwise."""
    text = F.trim(value.cast("string"), F.lit(" \t\r\n"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def is_integer(value: Column) -> Column:
    return parse_integer(value).isNotNull()


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add the names of the failed rules; a rule that gives NULL has failed."""
    failed = [
        F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules
    ]
    return df.withColumn(REASONS, F.array_compact(F.array(*failed)))


def check(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reasons, rejected rows with them)."""
    judged = apply_rules(df, rules)
    return (
        filter_here(judged, F.size(REASONS) == 0).drop(REASONS),
        filter_here(judged, F.size(REASONS) > 0),
    )
