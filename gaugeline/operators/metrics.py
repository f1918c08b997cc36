"""Operational summaries. All are partial-then-final hash aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def op_latency(timings: DataFrame) -> DataFrame:
    """Count, average, bounds and throughput per operation; the throughput is null
    when all timings are 0."""
    return timings.groupBy("op").agg(
        F.count("*").alias("ops"),
        F.sum("ns").alias("total_ns"),
        (F.sum("ns") / F.count("*")).alias("avg_ns"),
        F.min("ns").alias("min_ns"),
        F.max("ns").alias("max_ns"),
        F.try_divide(F.count("*"), F.sum("ns") / 1e9).alias("ops_per_second"),
    )


def hit_rate(timings: DataFrame) -> DataFrame:
    """Cache hits, misses and hit percentage of the reads; 0 without reads."""
    hits, reads = F.count_if(F.col("hit")), F.count("*")
    return timings.where(F.col("op") == "read").agg(
        hits.alias("hits"),
        (reads - hits).alias("misses"),
        F.coalesce(hits * 100.0 / F.nullif(reads, F.lit(0)), F.lit(0.0)).cast("double")
        .alias("hit_rate"),
    )


def raw_vs_unique(change_log: DataFrame) -> DataFrame:
    """Entries in an append log against the keys they stand for."""
    return change_log.agg(
        F.count("*").alias("raw_entries"), F.count_distinct("key").alias("unique_keys"))


def storage_summary(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Number and sizes of the files under a folder, from its listing alone: one row per file,
    whose content is not opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", pattern).load(path).select("length")
    zero = F.lit(0).cast("bigint")
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), zero).alias("bytes"),
        F.coalesce(F.min("length"), zero).alias("smallest"), F.coalesce(F.max("length"), zero).alias("largest"))


def station_counts(readings: DataFrame) -> DataFrame:
    """Records per station of a batch."""
    return readings.groupBy("station_id").agg(F.count("*").alias("records"))


def battery_share(readings: DataFrame) -> DataFrame:
    """Share of each battery status per station, in percent of the station's rows."""
    counts = readings.groupBy("station_id", "battery_status").agg(F.count("*").alias("n"))
    station = Window.partitionBy("station_id")
    return counts.select(
        "station_id", "battery_status", "n",
        F.round(F.col("n") * 100.0 / F.sum("n").over(station), 1).cast("double")
        .alias("percent"))


def subscriber_status(health: DataFrame, outages: DataFrame, missed: DataFrame,
                      replayed: DataFrame, as_of_ms: Column) -> DataFrame:
    """One row per subscriber: health flags, outage so far, pending and replayed counts.

    ``missed`` and ``replayed`` carry ``subscriber``; each side is counted per
    subscriber before the joins.
    """
    pending = missed.groupBy("subscriber").agg(F.count("*").alias("missed_pending"))
    done = replayed.groupBy("subscriber").agg(F.count("*").alias("replayed_total"))
    down = outages.groupBy("subscriber").agg(F.max("down_from_ms").alias("last_down_from_ms"))
    zero = F.lit(0).cast("bigint")
    return (
        health.join(pending, "subscriber", "left")
        .join(done, "subscriber", "left")
        .join(down, "subscriber", "left")
        .select(
            "subscriber", "healthy", "last_heartbeat_ms", "since_last_ms",
            "last_down_from_ms",
            F.coalesce("missed_pending", zero).alias("missed_pending"),
            F.coalesce("replayed_total", zero).alias("replayed_total"),
        )
    )
