"""JSON payload to typed reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import lenient_number
from ..functions.timeparts import utc_date
from ..schemas import READING, READING_AS_TEXT

PARSE_FAILED = "JSON parsing failed: payload does not bind to a reading"

_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_unparsed",
    "allowSingleQuotes": "false",
}
_LONGS = ("station_id", "s_no", "status_timestamp")
_INTS = ("humidity", "temperature", "wind_speed")


def evaluate_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns that later filters cannot be pushed below.

    Catalyst would otherwise repeat the parse, or every cast, inside each filter;
    the repeated code also outgrows what the JVM compiles.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))


def decode(arrivals: DataFrame, payload: str = "value") -> DataFrame:
    """Add the typed reading next to the transport columns.

    Adds ``station_id, s_no, battery_status, status_timestamp, weather``, plus
    ``parse_failed`` and ``is_null_reading`` (the payload was a literal ``null``).
    Missing numbers are 0, decimals are truncated, unknown fields are ignored.
    """
    value = F.col(payload)
    strict = arrivals.select("*", F.from_json(value, READING, _JSON_OPTIONS).alias("_strict"))
    fits = F.col("_strict").isNotNull() & F.col("_strict._unparsed").isNull()
    parsed = strict.select(
        "*",
        F.when(fits, F.col("_strict")).alias("_p"),
        F.when(~fits, F.from_json(value, READING_AS_TEXT, _JSON_OPTIONS)).alias("_t"))

    p, t = F.col("_p"), F.col("_t")
    leaves = {name: (p[name], t[name], "bigint") for name in _LONGS}
    leaves |= {name: (p["weather"][name], t["weather"][name], "int") for name in _INTS}
    numbers = parsed.select(
        "*", *[F.coalesce(number, lenient_number(text, kind)).alias(f"_{name}")
               for name, (number, text, kind) in leaves.items()])

    def bound(name: str) -> Column:
        return F.coalesce(F.col(f"_{name}"), F.lit(0).cast(leaves[name][2])).alias(name)

    null_literal = F.coalesce(F.btrim(value, F.lit(" \t\r\n")) == "null", F.lit(False))
    battery = F.coalesce(p["battery_status"], t["battery_status"])
    # An object or array where text is expected arrives as its JSON text.
    nested = F.coalesce(battery.startswith("{") | battery.startswith("["), F.lit(False))
    unbound = t.isNull() | t["_unparsed"].isNotNull()
    for name, (_, text, _) in leaves.items():
        unbound = unbound | (text.isNotNull() & F.col(f"_{name}").isNull())
    broken = nested | (p.isNull() & unbound)
    has_weather = p["weather"].isNotNull() | t["weather"].isNotNull()

    return evaluate_once(
        numbers,
        bound("station_id"), bound("s_no"), battery.alias("battery_status"),
        bound("status_timestamp"),
        F.when(has_weather, F.struct(*map(bound, _INTS))).alias("weather"),
        (broken & ~null_literal).alias("parse_failed"),
        null_literal.alias("is_null_reading"),
    ).drop("_strict", "_p", "_t", *[f"_{name}" for name in leaves])


def parsed_only(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("parse_failed"))


def parse_failures(decoded: DataFrame) -> DataFrame:
    """Rows that left the main path, with their error list."""
    return decoded.where("parse_failed").withColumn(
        "validation_errors", F.array(F.lit(PARSE_FAILED)))


def flatten(readings: DataFrame) -> DataFrame:
    """Payload columns side by side plus UTC ``year, month, day`` of each row."""
    weather = F.col("weather")
    date = utc_date(F.col("status_timestamp"))
    return readings.select(
        "*",
        *[F.coalesce(weather[name], F.lit(0)).alias(name) for name in _INTS],
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.day(date).alias("day"),
    )
