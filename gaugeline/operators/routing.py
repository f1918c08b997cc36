"""Content-based routing from a table of named rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import ROUTED_RAIN_TOPIC
from .alerts import is_rain

Rule = tuple[str, Column]


def default_rules() -> list[Rule]:
    return [(ROUTED_RAIN_TOPIC, is_rain())]


def routes(rules: list[Rule]) -> Column:
    """Names of the topics a row goes to, in rule order."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(topic)) for topic, rule in rules]))


def routed_messages(readings: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per message and topic: re-keyed by station, payload verbatim."""
    return readings.select(
        F.explode(routes(rules or default_rules())).alias("topic"),
        F.concat(F.lit("station-"), F.col("station_id").cast("string")).alias("key"),
        "value",
    )
