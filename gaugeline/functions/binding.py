"""Turn loosely typed JSON leaves into numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def lenient_number(text: Column, sql_type: str) -> Column:
    """Integer of ``text``, truncating decimals; null when it is not a number in range.

    The decimal holds every 64-bit integer. Casting to the integer type first
    would be slower: a cast that fails costs far more than one that works.
    """
    return F.coalesce(
        text.try_cast("decimal(38,6)").try_cast(sql_type),
        F.when(text == "", F.lit(0).cast(sql_type)),
    )


def number_or_zero(text: Column, sql_type: str = "int") -> Column:
    """Integer of ``text`` with every miss read as 0 and JSON ``true`` read as 1."""
    return F.coalesce(
        F.when(text == "true", F.lit(1).cast(sql_type)),
        lenient_number(text, sql_type),
        F.lit(0).cast(sql_type),
    )
