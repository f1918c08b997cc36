"""Raw responses of the public Open-Meteo API to readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.binding import number_or_zero
from ..session import materialise
from .decode import evaluate_once
from .sequences import number_rows

BATTERY = "high"
_HOUR_US = 3_600_000_000
_LEAVES = {
    "humidity": "relative_humidity_2m",
    "temperature": "temperature_2m",
    "wind_speed": "wind_speed_10m",
}


def parsed_responses(responses: DataFrame) -> DataFrame:
    """Readings of the successful, well-formed responses, not yet numbered."""
    fetched = responses.where("status = 200").select(
        "station_id", F.unix_micros("fetched_at").alias("fetched_us"),
        F.try_parse_json("body").alias("doc"))
    leaves = fetched.select(
        "station_id", "fetched_us", F.col("doc").isNotNull().alias("well_formed"),
        *[F.try_variant_get("doc", f"$.current.{leaf}", "string").alias(name)
          for name, leaf in _LEAVES.items()])
    return evaluate_once(
        leaves,
        F.col("well_formed").alias("usable"),
        F.floor(F.col("fetched_us") / 1_000_000).alias("status_timestamp"),
        F.struct(*[number_or_zero(F.col(name)).alias(name) for name in _LEAVES]).alias("weather"),
    ).where("usable").select("station_id", "fetched_us", "status_timestamp", "weather")


def normalise_responses(responses: DataFrame) -> DataFrame:
    """``(station_id, fetched_at, status, body)`` to reading columns.

    Only successful, well-formed responses count; ``s_no`` is their running
    number per station in fetch order, responses of one moment by their values.
    Numbering reads its input twice, so the parsed readings are written first and
    the responses read and parsed once.
    """
    readings = materialise(parsed_responses(responses), "forecast-readings")
    numbered = number_rows(readings, ["station_id"], ["fetched_us", "weather"], "s_no", width=_HOUR_US)
    return numbered.select(
        "station_id", "s_no", F.lit(BATTERY).alias("battery_status"), "status_timestamp",
        "weather")
