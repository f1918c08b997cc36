"""Put stored messages back in front of the live ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def missed_as_arrivals(missed: DataFrame, replay_ts: Column) -> DataFrame:
    """Missed messages as arrivals stamped with the replay time."""
    return missed.select(
        F.lit(None).cast("string").alias("key"),
        F.col("originalMessage").alias("value"),
        F.col("kafkaPartition").alias("kafka_partition"),
        F.col("kafkaOffset").alias("kafka_offset"),
        replay_ts.alias("arrival_ts"),
    )


def dead_letters_as_arrivals(dead: DataFrame, replay_ts: Column) -> DataFrame:
    """Original payloads of dead letters, not their envelopes, as arrivals."""
    return dead.select(
        F.col("station_id").cast("string").alias("key"),
        F.col("original_message").alias("value"),
        "kafka_partition", "kafka_offset",
        replay_ts.alias("arrival_ts"),
    )


def with_replayed(replayed: DataFrame, live: DataFrame) -> DataFrame:
    """One input for the ordinary transforms; de-duplication makes it idempotent."""
    return replayed.unionByName(live)
