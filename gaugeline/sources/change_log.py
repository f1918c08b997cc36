"""Append-only change log: one directory per segment, oldest first by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CHANGE_LOG
from .tables import read_or_empty


def write_change_log(entries: DataFrame, path: str) -> None:
    """Append entries, rebalanced so that a segment is a few files and a large
    one is written by several tasks."""
    entries.select("segment", "pos", "key", "value").hint("rebalance", "segment") \
        .write.mode("append").partitionBy("segment").parquet(path)


def read_change_log(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, CHANGE_LOG).select("segment", "pos", "key", "value")
