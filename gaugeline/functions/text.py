"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(text: Column) -> Column:
    """Only white space of any kind, tabs and line breaks included."""
    return text.rlike(r"^\s*$")


def zero_padded(number: Column, width: int) -> Column:
    return F.format_string(f"%0{width}d", number)


def clipped(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def one_decimal(number: Column) -> Column:
    """Display form with one decimal, half up."""
    return F.format_string("%.1f", number)


def base64_line(text: Column) -> Column:
    """Base64 of UTF-8 text on a single line."""
    return F.translate(F.base64(F.encode(text, "UTF-8")), "\r\n", "")


def from_base64(encoded: Column) -> Column:
    """UTF-8 text of a base64 string; null when it is not base64."""
    return F.try_to_binary(F.trim(encoded), F.lit("base64")).cast("string")


def csv_quoted(text: Column) -> Column:
    """One CSV field in quotes, inner quotes doubled."""
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def display_key(*parts: Column) -> Column:
    return F.concat_ws(":", *[part.cast("string") for part in parts])
