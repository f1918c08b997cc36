"""Validation rules as column expressions.

Every rule is reported, in a fixed order; nothing short-circuits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import (
    BATTERY_STATUSES, HUMIDITY_RANGE, MIN_WIND_SPEED, TEMPERATURE_RANGE,
)
from ..functions.text import is_blank
from .decode import PARSE_FAILED


def _rules() -> list[tuple[Column, Column]]:
    """(violated, message) in report order."""
    station, seq, stamp = F.col("station_id"), F.col("s_no"), F.col("status_timestamp")
    battery, weather = F.col("battery_status"), F.col("weather")
    humidity, temperature = weather["humidity"], weather["temperature"]
    wind = weather["wind_speed"]
    no_battery = battery.isNull() | is_blank(battery)
    low_h, high_h = HUMIDITY_RANGE
    low_t, high_t = TEMPERATURE_RANGE

    def said(prefix: str, value: Column, suffix: str = "") -> Column:
        return F.concat(F.lit(prefix), value.cast("string"), F.lit(suffix))

    return [
        (station <= 0, said("station_id must be positive, got: ", station)),
        (seq < 0, said("s_no must be non-negative, got: ", seq)),
        (no_battery, F.lit("battery_status is null or empty")),
        (~no_battery & ~F.lower(battery).isin(*BATTERY_STATUSES),
         said(f"battery_status must be one of [{', '.join(BATTERY_STATUSES)}], got: '",
              battery, "'")),
        (stamp <= 0, said("status_timestamp must be positive, got: ", stamp)),
        (weather.isNull(), F.lit("weather data is null")),
        (~humidity.between(low_h, high_h),
         said(f"humidity must be between {low_h} and {high_h}, got: ", humidity)),
        (~temperature.between(low_t, high_t),
         said(f"temperature must be between {low_t}°F and {high_t}°F, got: ",
              temperature, "°F")),
        (wind < MIN_WIND_SPEED,
         said("wind_speed must be non-negative (km/h), got: ", wind)),
    ]


def is_valid() -> Column:
    """True when no rule is violated: one short comparison per field, no messages.

    A known battery status is neither null nor blank, so that rule needs no test.
    """
    weather = F.col("weather")
    return (
        ~F.col("parse_failed") & ~F.col("is_null_reading")
        & (F.col("station_id") > 0) & (F.col("s_no") >= 0)
        & F.coalesce(F.lower("battery_status").isin(*BATTERY_STATUSES), F.lit(False))
        & (F.col("status_timestamp") > 0) & weather.isNotNull()
        & weather["humidity"].between(*HUMIDITY_RANGE)
        & weather["temperature"].between(*TEMPERATURE_RANGE)
        & (weather["wind_speed"] >= MIN_WIND_SPEED)
    )


def validation_errors() -> Column:
    """All violated rules in order; empty for a valid reading."""
    messages = F.array_compact(F.array(*[F.when(bad, text) for bad, text in _rules()]))
    return (
        F.when(F.col("parse_failed"), F.array(F.lit(PARSE_FAILED)))
        .when(F.col("is_null_reading"), F.array(F.lit("WeatherReading is null")))
        .otherwise(messages)
    )


def accepted(decoded: DataFrame) -> DataFrame:
    """Readings without errors."""
    return decoded.where(is_valid()).drop("parse_failed", "is_null_reading")


def rejected(decoded: DataFrame) -> DataFrame:
    """Everything else, with ``validation_errors``; messages are built here only."""
    return decoded.where(~is_valid()).withColumn("validation_errors", validation_errors())


def error_rows(rejects: DataFrame) -> DataFrame:
    """One row per error, numbered from 1 within its message."""
    return rejects.select(
        "kafka_partition", "kafka_offset",
        F.posexplode("validation_errors").alias("pos", "error"),
    ).select(
        "kafka_partition", "kafka_offset", (F.col("pos") + 1).alias("error_no"), "error")
