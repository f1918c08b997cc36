"""Queries over dead letters: list, view, search, count and sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import clipped
from ..functions.timeparts import utc_timestamp_text

_UNKNOWN = "Unknown"
_NO_STATION = -1
_EXCEPTION_WIDTH = 20


def _exception() -> Column:
    return F.coalesce("exception_type", F.lit(_UNKNOWN))


def _short_exception() -> Column:
    return clipped(_exception(), _EXCEPTION_WIDTH).alias("exception")


def _station() -> Column:
    return F.coalesce("station_id", F.lit(_NO_STATION).cast("bigint")).alias("station")


def file_label() -> Column:
    return F.concat(F.col("failed_at_timestamp_ms").cast("string"), F.lit("_offset_"),
                    F.col("kafka_offset").cast("string"), F.lit(".json"))


def list_stage(letters: DataFrame) -> DataFrame:
    """Offset, failure time, station and exception, oldest first."""
    return letters.orderBy("failed_at_timestamp_ms", "kafka_offset").select(
        "kafka_offset", utc_timestamp_text(F.col("failed_at_timestamp_ms")).alias("failed_at"),
        _station(), _short_exception())


def view(letters: DataFrame, offset: int) -> DataFrame:
    """The first dead letter with exactly this offset."""
    return letters.where(F.col("kafka_offset") == offset) \
        .orderBy("failed_at_timestamp_ms", "kafka_partition").limit(1)


def details(letters: DataFrame) -> DataFrame:
    """All fields with one row per failure reason and the payload length."""
    return letters.select(
        "processing_stage", "kafka_offset", "kafka_partition", "station_id", "sequence_number",
        utc_timestamp_text(F.col("failed_at_timestamp_ms")).alias("failed_at"),
        "exception_type", "exception_message",
        F.posexplode_outer("failure_reasons").alias("reason_pos", "reason"),
        F.length("original_message").alias("message_chars"),
        "original_message",
    )


def station_failures(letters: DataFrame) -> DataFrame:
    """Failures of one station by date."""
    return letters.orderBy("dl_date", "stage", "kafka_offset").select(
        "dl_date", "stage", "kafka_offset", _short_exception())


def search(letters: DataFrame, pattern: str) -> DataFrame:
    """Case-insensitive pattern anywhere in a known exception type."""
    return letters.where(F.col("exception_type").rlike(f"(?i){pattern}")).select(
        "dl_date", "stage", _station(), _short_exception())


def _share(letters: DataFrame, group: Column) -> DataFrame:
    """Count and one-decimal percentage. The unpartitioned window only sees the
    one row per group left by the aggregation."""
    total = F.sum("messages").over(Window.partitionBy())
    return letters.groupBy(group).agg(F.count("*").alias("messages")).withColumn(
        "percent", F.round(F.col("messages") * F.lit(100.0) / total, 1))


def stage_stats(letters: DataFrame) -> DataFrame:
    return _share(letters, F.col("stage")).orderBy("stage")


def exception_stats(letters: DataFrame) -> DataFrame:
    return _share(letters, _exception().alias("exception")) \
        .orderBy(F.desc("messages"), "exception")


def stage_counts(letters: DataFrame) -> DataFrame:
    return letters.groupBy("stage").agg(F.count("*").alias("messages"))


def dates_and_stages(letters: DataFrame) -> DataFrame:
    return letters.select("dl_date", "stage").distinct().orderBy("dl_date", "stage")


def first_per_stage(letters: DataFrame, shown: int = 5) -> DataFrame:
    """The oldest few labels of each stage and how many more there are.

    The rank limit prunes before the shuffle; the totals are a separate
    aggregate, so no stage is gathered in one task.
    """
    by_age = Window.partitionBy("stage").orderBy(
        "failed_at_timestamp_ms", "kafka_offset", "kafka_partition")
    top = letters.select(
        "stage", "failed_at_timestamp_ms", "kafka_offset", "kafka_partition",
        file_label().alias("file"),
    ).withColumn("nth", F.row_number().over(by_age)).where(F.col("nth") <= shown)
    return top.join(stage_counts(letters), "stage").select(
        "stage", "nth", "file", "messages",
        F.greatest(F.col("messages") - shown, F.lit(0)).alias("more"))


def replay_samples(letters: DataFrame, shown: int = 3) -> DataFrame:
    """The oldest few to replay, with the total and the remainder."""
    total = letters.agg(F.count("*")).scalar()
    return letters.orderBy("failed_at_timestamp_ms", "kafka_offset", "kafka_partition") \
        .limit(shown).select(
            file_label().alias("file"), "kafka_offset", total.alias("messages"),
            F.greatest(total - shown, F.lit(0)).alias("more"))
