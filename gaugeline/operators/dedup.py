"""Batch forms of the idempotent receiver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEDUP_CAPACITY
from .validate import is_valid

DEDUP_KEY = ("station_id", "s_no")


def keep_first(readings: DataFrame, keys: tuple[str, ...] = DEDUP_KEY) -> DataFrame:
    """First arrival per key.

    ``row_number() = 1`` lets Spark drop later copies before the shuffle
    (window group limit), so a heavily redelivered message costs one row per
    input partition.
    """
    order = [c for c in ("kafka_offset", "kafka_partition") if c in readings.columns]
    first = Window.partitionBy(*keys).orderBy(*order)
    return readings.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def channel_counts(decoded: DataFrame) -> DataFrame:
    """How many arrivals are accepted, duplicate or invalid, in one pass.

    Invalid rows share one group without a key; partial aggregation reduces it
    before the shuffle.
    """
    ok = is_valid()
    groups = decoded.select(ok.alias("ok"), *[F.when(ok, F.col(k)).alias(k) for k in DEDUP_KEY]) \
        .groupBy("ok", *DEDUP_KEY).agg(F.count("*").alias("n"))
    good = F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0))
    keys = F.count_if(F.col("ok"))
    bad = F.coalesce(F.sum(F.when(~F.col("ok"), F.col("n"))), F.lit(0))
    totals = groups.agg(F.array(*[
        F.struct(F.lit(channel).alias("channel"), count.alias("messages"))
        for channel, count in (("accepted", keys), ("duplicate", good - keys), ("invalid", bad))
    ]).alias("totals"))
    return totals.select(F.inline("totals"))


def eviction_set(tracked: DataFrame, capacity: int = DEDUP_CAPACITY) -> DataFrame:
    """The oldest tenth of the capacity, when more keys than that are tracked.

    ``tracked`` has ``station_id, s_no, recorded_at``. The plan is a bounded
    top-k guarded by a scalar subquery.
    """
    size = tracked.agg(F.count("*")).scalar()
    return (
        tracked.where(size > capacity)
        .orderBy("recorded_at", "station_id", "s_no")
        .limit(capacity // 10)
    )


def older_than(tracked: DataFrame, recorded_before: int) -> DataFrame:
    """Keys an age eviction would drop."""
    return tracked.where(F.col("recorded_at") < recorded_before)
