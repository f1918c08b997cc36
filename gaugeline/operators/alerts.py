"""Rain alerts: the predicate, the alert row and the alert message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import RAIN_ALERT_TYPE, RAIN_HUMIDITY_THRESHOLD


def is_rain(threshold: int = RAIN_HUMIDITY_THRESHOLD) -> Column:
    """Humidity strictly above the threshold; a reading without weather never is."""
    return F.coalesce(F.col("weather")["humidity"] > threshold, F.lit(False))


def alert_rows(readings: DataFrame, threshold: int = RAIN_HUMIDITY_THRESHOLD) -> DataFrame:
    """Rainy readings reshaped to alerts."""
    return readings.where(is_rain(threshold)).select(
        "station_id",
        F.lit(RAIN_ALERT_TYPE).alias("alert_type"),
        "weather.humidity", "weather.temperature", "weather.wind_speed",
        "status_timestamp",
    )


def alert_messages(decoded: DataFrame, threshold: int = RAIN_HUMIDITY_THRESHOLD) -> DataFrame:
    """Key and JSON of every rainy message, unvalidated and not de-duplicated."""
    rainy = decoded.where(~F.col("parse_failed") & is_rain(threshold))
    alert = F.struct(
        F.col("station_id"),
        F.lit(RAIN_ALERT_TYPE).alias("alert_type"),
        F.col("weather.humidity"), F.col("weather.temperature"), F.col("weather.wind_speed"),
        F.col("status_timestamp"),
    )
    return rainy.select("key", F.to_json(alert, {"ignoreNullFields": "false"}).alias("value")) \
        .where(F.col("value").isNotNull())
