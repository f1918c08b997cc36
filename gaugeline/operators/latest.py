"""Latest value per key, lookups and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest_by_station(readings: DataFrame) -> DataFrame:
    """Newest payload per station. A station lives in one partition of the
    source, so its offset is its arrival order; partial aggregation leaves one
    row per station and task to shuffle."""
    newest = F.max_by(
        F.struct("value", "kafka_partition", "kafka_offset"), F.col("kafka_offset"))
    return (
        readings.groupBy(F.col("station_id").cast("string").alias("key"))
        .agg(newest.alias("_last"))
        .select("key", "_last.*")
    )


def compact_log(change_log: DataFrame) -> DataFrame:
    """Newest value per key over an append-only log ordered by (segment, pos)."""
    return change_log.groupBy("key").agg(
        F.max_by("value", F.struct("segment", "pos")).alias("value"))


def point_lookup(latest: DataFrame, key: str) -> DataFrame:
    """The row of one key; no row means not found."""
    return latest.where(F.col("key") == key)


def batch_lookup(probes: DataFrame, latest: DataFrame) -> DataFrame:
    """Every probe with the value found, or null."""
    return probes.join(latest.select("key", "value"), "key", "left")


def lookup_counts(probes: DataFrame, latest: DataFrame) -> DataFrame:
    """Hits and misses per key. Probes are counted per key first, so a key
    probed very often joins as one row."""
    asked = probes.groupBy("key").agg(F.count("*").alias("probes"))
    found = F.col("value").isNotNull()
    zero = F.lit(0).cast("bigint")
    return batch_lookup(asked, latest).select(
        "key", "probes",
        F.when(found, F.col("probes")).otherwise(zero).alias("hits"),
        F.when(found, zero).otherwise(F.col("probes")).alias("misses"),
    )


def missing_keys(probes: DataFrame, latest: DataFrame) -> DataFrame:
    """Distinct probed keys that were never written."""
    return probes.select("key").distinct().join(latest.select("key"), "key", "left_anti")


def reconcile(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Status per key: ok, mismatch, missing (not stored) or extra (not expected)."""
    left = expected.select("key", F.col("value").alias("wanted"), F.lit(True).alias("_e"))
    right = stored.select("key", F.col("value").alias("found"), F.lit(True).alias("_s"))
    status: Column = (
        F.when(F.col("_s").isNull(), "missing")
        .when(F.col("_e").isNull(), "extra")
        .when(F.col("wanted").eqNullSafe(F.col("found")), "ok")
        .otherwise("mismatch")
    )
    return left.join(right, "key", "full_outer").select("key", status.alias("status"))
