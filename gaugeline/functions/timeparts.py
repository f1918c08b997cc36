"""Time helpers. All use UTC whatever the session zone is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SECONDS_PER_DAY = 86_400


def utc_date(epoch_seconds: Column) -> Column:
    day = F.floor(epoch_seconds / SECONDS_PER_DAY).try_cast("int")
    return F.date_from_unix_date(day)


def utc_date_text(epoch_millis: Column) -> Column:
    return utc_date(millis_to_seconds(epoch_millis)).cast("string")


def seconds_to_millis(epoch_seconds: Column) -> Column:
    """Null where the result leaves a long."""
    return F.try_multiply(epoch_seconds, F.lit(1000).cast("bigint"))


def millis_to_seconds(epoch_millis: Column) -> Column:
    return F.floor(epoch_millis / 1000)


def utc_timestamp_text(epoch_millis: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, fractions dropped."""
    return F.timestamp_add(
        "SECOND", millis_to_seconds(epoch_millis),
        F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
    ).cast("string")


def ntz_to_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp read as UTC."""
    return F.timestamp_diff(
        "MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def readable_stamp(compact: Column) -> Column:
    """``yyyyMMddHHmmss`` or ``yyyyMMddHHmmss_NNN`` made readable; other text unchanged."""
    digits = F.split(compact, "_").getItem(0)
    parsed = F.when(
        digits.rlike(r"^\d{14}$"),
        F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")),
    )
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), compact)
