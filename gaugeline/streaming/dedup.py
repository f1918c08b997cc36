"""Idempotent receiver on a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.decode import decode
from ..operators.dedup import DEDUP_KEY
from ..operators.validate import accepted


def _first_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.table([batch.column(key) for key in DEDUP_KEY], names=list(DEDUP_KEY))
        table = table.append_column("row", pa.array(np.arange(batch.num_rows)))
        first = table.group_by(list(DEDUP_KEY), use_threads=False).aggregate([("row", "min")])
        if first.num_rows < batch.num_rows:
            batch = batch.take(first.column("row_min").combine_chunks())
        yield batch


def collapse_copies(readings: DataFrame) -> DataFrame:
    """Drop copies inside each Arrow batch, before the shuffle.

    Streaming de-duplication has no map-side step of its own: without this, all
    copies of one message in a micro-batch would go to the same task.
    """
    return readings.mapInArrow(_first_copies, readings.schema)


def unique_readings(arrivals: DataFrame, horizon: str, collapse: bool = True,
                    keep_time: bool = False) -> DataFrame:
    """Valid readings, first seen per (station_id, s_no).

    Invalid rows are filtered first and never enter the state. The watermark is
    on the time of the micro-batch, which a retried batch keeps: no row is ever
    late, however old its own or its arrival time is. A key is forgotten when it
    was first seen more than ``horizon`` ago. ``keep_time`` leaves the time of the
    micro-batch in ``seen_at``.
    """
    readings = accepted(decode(arrivals))
    if collapse:
        readings = collapse_copies(readings)
    first = readings.withColumn("seen_at", F.current_timestamp()) \
        .withWatermark("seen_at", horizon) \
        .dropDuplicatesWithinWatermark(list(DEDUP_KEY))
    return first if keep_time else first.drop("seen_at")


def tracked_keys(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """The keys a stopped or running query remembers, with their expiry."""
    state = spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
    return state.select(
        "key.station_id", "key.s_no",
        F.col("value.expiresAtMicros").alias("expires_at_us"))
