"""Envelopes around messages that could not be processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import STAGE_UNKNOWN
from ..functions.timeparts import utc_date_text


def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def invalid_messages(rejects: DataFrame, rejected_at_ms: Column | None = None) -> DataFrame:
    """Invalid-channel envelopes as JSON. No key."""
    envelope = F.struct(
        F.col("value").alias("original_message"),
        F.col("validation_errors"),
        (now_ms() if rejected_at_ms is None else rejected_at_ms).alias("rejected_at_timestamp"),
        F.col("kafka_offset"),
        F.col("kafka_partition"),
    )
    return rejects.select(F.to_json(envelope, {"ignoreNullFields": "false"}).alias("value"))


def dead_letters(
    failed: DataFrame,
    stage: Column,
    reasons: Column,
    exception_type: Column,
    exception_message: Column,
    failed_at_ms: Column | None = None,
) -> DataFrame:
    """Dead-letter rows with their partition columns ``dl_date`` and ``stage``."""
    rows = failed.select(
        F.col("value").alias("original_message"),
        reasons.cast("array<string>").alias("failure_reasons"),
        (now_ms() if failed_at_ms is None else failed_at_ms).cast("bigint")
        .alias("failed_at_timestamp_ms"),
        F.col("kafka_offset"),
        F.col("kafka_partition"),
        stage.cast("string").alias("processing_stage"),
        exception_type.cast("string").alias("exception_type"),
        exception_message.cast("string").alias("exception_message"),
        F.col("station_id"),
        F.col("s_no").alias("sequence_number"),
    )
    return rows.select(
        "*",
        utc_date_text(F.col("failed_at_timestamp_ms")).alias("dl_date"),
        F.coalesce("processing_stage", F.lit(STAGE_UNKNOWN)).alias("stage"),
    )
