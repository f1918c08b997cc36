"""Stations that stopped sending, by the time of their readings or by the clock."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.decode import decode
from ..operators.validate import accepted

ALARM = "station_id bigint, readings bigint, last_seen_us bigint, silent_at_ms bigint"


def silent_stations(arrivals: DataFrame, timeout: str, delay: str) -> DataFrame:
    """A row per station each time nothing valid came for longer than ``timeout``.

    A session window that closes is exactly that event. Sessions are merged per
    task before the shuffle, so a busy station sends one row per session and task.
    """
    session = F.session_window("arrival_ts", timeout)
    return (
        accepted(decode(arrivals)).withWatermark("arrival_ts", delay)
        .groupBy("station_id", session)
        .agg(F.count("*").alias("readings"), F.max("arrival_ts").alias("last_seen"))
        .select(
            "station_id", "readings",
            F.unix_micros("last_seen").alias("last_seen_us"),
            F.unix_micros("session_window.end").alias("silent_from_us"),
        )
    )


def _heard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per station and Arrow batch, so that a busy station does not fill a task."""
    for batch in batches:
        table = pa.table([batch.column(c) for c in ("station_id", "seen_us")], names=["station_id", "seen_us"])
        found = table.group_by("station_id", use_threads=False).aggregate([("seen_us", "count"), ("seen_us", "max")])
        yield from found.select(["station_id", "seen_us_count", "seen_us_max"]).rename_columns(
            ["station_id", "readings", "last_seen_us"]).combine_chunks().to_batches()


class _Alarm(StatefulProcessor):
    """Per station: what was heard, and one timer that is moved on when it fires too early."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("heard", "readings bigint, last_seen_us bigint, heard_ms bigint, armed boolean")

    def _known(self) -> tuple:
        return tuple(self.state.get()) if self.state.exists() else (0, None, 0, False)

    def _arm(self, readings: int, last_seen_us: int | None, heard_ms: int, armed: bool) -> None:
        if not armed:
            self.handle.registerTimer(heard_ms + self.timeout_ms)
        self.state.update((readings, last_seen_us, heard_ms, True))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        readings, last, _, armed = self._known()
        for part in rows:
            readings += int(part["readings"].sum())
            last = max(last or 0, int(part["last_seen_us"].max()))
        self._arm(readings, last, timerValues.getCurrentProcessingTimeInMs(), armed)
        return iter(())

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._arm(0, None, timerValues.getCurrentProcessingTimeInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        readings, last, heard_ms, _ = self._known()
        due = heard_ms + self.timeout_ms
        if due > timerValues.getCurrentProcessingTimeInMs():  # heard again since it was set
            self.handle.registerTimer(due)
            return
        self.state.update((readings, last, heard_ms, False))
        yield pd.DataFrame({"station_id": [key[0]], "readings": [readings],
                            "last_seen_us": pd.array([last], "Int64"), "silent_at_ms": [due]})


def silence_alarms(arrivals: DataFrame, timeout_ms: int, roster: DataFrame | None = None) -> DataFrame:
    """A row per station each time nothing valid was heard for ``timeout_ms`` by the clock:
    also when the whole feed stops, and for stations of ``roster`` (``station_id``, one row
    each) that never send. ``readings`` counts what was heard in all.

    For triggers that go on: with ``availableNow`` the query would wait for alarms for ever.
    """
    heard = accepted(decode(arrivals)).select("station_id", F.unix_micros("arrival_ts").alias("seen_us")) \
        .mapInArrow(_heard, "station_id bigint, readings bigint, last_seen_us bigint")
    return heard.groupBy("station_id").transformWithStateInPandas(
        _Alarm(timeout_ms), ALARM, "Append", "ProcessingTime",
        initialState=roster.select("station_id").groupBy("station_id") if roster is not None else None)
