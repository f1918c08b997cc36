"""Outages from heartbeats, and the messages that arrived during them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import HEARTBEAT_TIMEOUT_MS
from ..functions.timeparts import utc_date_text, utc_timestamp_text


def outage_intervals(
    heartbeats: DataFrame,
    timeout_ms: int = HEARTBEAT_TIMEOUT_MS,
    who: str = "subscriber",
    at: str = "beat_ms",
    as_of_ms: int | None = None,
    roster: DataFrame | None = None,
    open_ended: bool = False,
) -> DataFrame:
    """Intervals ``[down_from_ms, down_to_ms)`` in which the last heartbeat was
    ``timeout_ms`` old or older.

    Two beats in the same window of ``timeout_ms`` cannot be further apart than
    that, so keeping the first and last beat per window loses nothing. The
    reduction happens before the shuffle; what is left to order per subscriber
    grows with elapsed time, not with the number of beats. ``as_of_ms`` closes
    an outage that is still open then, or with ``open_ended`` reports it without
    an end. Members of ``roster`` (``who``, ``enrolled_ms``) are down from their
    enrolment until their first beat, if there ever is one.
    """
    beats = heartbeats.select(who, F.col(at).alias("_at"))
    if roster is not None:
        # Without a beat yet, as if the last one had just run out.
        beats = beats.unionByName(roster.select(who, (F.col("enrolled_ms") - timeout_ms).alias("_at")))
    slots = beats.groupBy(who, F.floor(F.col("_at") / timeout_ms).alias("_slot")).agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    following = F.lead("_first").over(Window.partitionBy(who).orderBy("_slot"))
    spans = slots.select(who, (F.col("_last") + timeout_ms).alias("down_from_ms"),
                         following.alias("down_to_ms"))
    if as_of_ms is None:
        return spans.where(F.col("down_to_ms") > F.col("down_from_ms"))
    as_of = F.lit(as_of_ms).cast("bigint")
    down = spans.where(F.coalesce("down_to_ms", as_of + (1 if open_ended else 0)) > F.col("down_from_ms"))
    return down if open_ended else down.withColumn("down_to_ms", F.coalesce("down_to_ms", as_of))


def health(heartbeats: DataFrame, as_of_ms: Column, timeout_ms: int = HEARTBEAT_TIMEOUT_MS,
           roster: DataFrame | None = None) -> DataFrame:
    """Last heartbeat, its age and the health flag per subscriber.

    Members of ``roster`` that never beat are listed as unhealthy.
    """
    last = heartbeats.groupBy("subscriber").agg(F.max("beat_ms").alias("last_heartbeat_ms"))
    if roster is not None:
        last = roster.select("subscriber").distinct().join(last, "subscriber", "left")
    age = as_of_ms - F.col("last_heartbeat_ms")
    return last.select(
        "subscriber", "last_heartbeat_ms",
        age.alias("since_last_ms"),
        F.coalesce(age < timeout_ms, F.lit(False)).alias("healthy"),
    )


BUCKET_MS = 3_600_000


def outage_spans(outages: DataFrame, bucket_ms: int = BUCKET_MS,
                 watermark_ms: int | None = None) -> DataFrame:
    """One row per outage and time bucket it touches. An open outage lasts up to and
    including ``watermark_ms``, the latest moment the arrivals are known to cover."""
    if watermark_ms is not None:
        outages = outages.withColumn(
            "down_to_ms", F.coalesce("down_to_ms", F.lit(watermark_ms + 1).cast("bigint"))
        ).where("down_to_ms > down_from_ms")
    first = F.floor(F.col("down_from_ms") / bucket_ms)
    last = F.floor((F.col("down_to_ms") - 1) / bucket_ms)
    return outages.select(
        "subscriber", "down_from_ms", "down_to_ms",
        F.explode(F.sequence(first, last)).alias("_bucket"))


def capture_missed(arrivals: DataFrame, spans: DataFrame, subscriber: Column,
                   bucket_ms: int = BUCKET_MS) -> DataFrame:
    """Arrivals that came in while their subscriber was down.

    The interval join becomes an equi-join on (subscriber, time bucket) plus a
    range test. Outages of one subscriber do not overlap, so an arrival matches
    at most one. Pass the spans as a written table (``session.materialise``):
    Catalyst then knows their size and broadcasts them only below the session's
    threshold; above it, AQE splits a bucket that holds too many arrivals.
    """
    arrived = F.unix_millis("arrival_ts")
    stamped = arrivals.select(
        "*", subscriber.alias("subscriber"), arrived.alias("_arrived_ms"),
        F.floor(arrived / bucket_ms).alias("_bucket"))
    return (
        stamped.join(spans, ["subscriber", "_bucket"])
        .where((F.col("_arrived_ms") >= F.col("down_from_ms"))
               & (F.col("_arrived_ms") < F.col("down_to_ms")))
        .select(*arrivals.columns, "subscriber", "_arrived_ms", "down_from_ms")
        .withColumnsRenamed({"_arrived_ms": "arrived_ms"})
    )


def missed_rows(captured: DataFrame) -> DataFrame:
    """Captured arrivals as missed messages, with their partition date."""
    return captured.select(
        F.col("value").alias("originalMessage"),
        F.col("kafka_offset").alias("kafkaOffset"),
        F.col("kafka_partition").alias("kafkaPartition"),
        F.col("arrived_ms").alias("messageTimestamp"),
        F.col("arrived_ms").alias("missedAtTimestamp"),
        utc_timestamp_text(F.col("down_from_ms")).alias("downDetectionTime"),
        utc_date_text(F.col("arrived_ms")).alias("missed_date"),
    )
