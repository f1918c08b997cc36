"""The multi-sink job: de-duplicated readings to routes, archive and latest values."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ROUTED_RAIN_TOPIC, STAGE_ARCHIVE, STAGE_LATEST, PipelineSettings
from ..operators.alerts import is_rain
from ..operators.envelopes import dead_letters
from ..operators.routing import routed_messages
from ..sources.archive import archive_rows
from ..sources.commits import BATCH, CommitLog
from ..sources.dead_letters import DeadLetterStore
from ..sources.latest_store import LatestStore
from ..sources.live_archive import LiveArchive
from .dedup import unique_readings

log = logging.getLogger(__name__)

Writer = Callable[[DataFrame, int], None]


class FanOut:
    """Writes one micro-batch to every sink under its batch id, then commits the id.

    Readers see committed batches only, so all sinks change at one moment; each sink
    replaces what an earlier try of the same batch left, and a batch that was
    committed is not written again. A failing archive or latest-value sink
    turns its rows into dead letters and the stream goes on; the latest-value
    failure is recorded only when the archive took the rows. A failing route
    fails the batch, which is then retried. ``replay_job`` brings dead letters back.
    """

    def __init__(self, spark: SparkSession, root: str,
                 settings: PipelineSettings = PipelineSettings(),
                 archive_writer: Writer | None = None,
                 latest_writer: Writer | None = None,
                 route_writer: Writer | None = None):
        self.root = root.rstrip("/")
        self.settings = settings
        self._rows = 0
        self._last: int | None = None  # committed; this job is the only writer
        self.log = CommitLog(spark, f"{self.root}/commits")
        self.archive = LiveArchive(spark, f"{self.root}/archive", self.log)
        self.latest = LatestStore(spark, f"{self.root}/latest", self.log)
        self.dead = DeadLetterStore(spark, f"{self.root}/dead-letters", self.log)
        self._archive = archive_writer or self._write_archive
        self._latest = latest_writer or self._write_latest
        self._route = route_writer or self._write_routed

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self._last is None:
            self._last = self.log.last(BATCH)
        if batch_id <= self._last:
            return
        batch = batch.persist()
        try:
            self._rows = batch.count()
            if self._rows:
                self._route(batch, batch_id)
                archived = self._try(self._archive, batch, batch_id, STAGE_ARCHIVE)
                self._try(self._latest, batch, batch_id, STAGE_LATEST, record=archived)
            self.log.commit(BATCH, batch_id, self._last)
            self._last = batch_id
        finally:
            batch.unpersist()
        if (batch_id + 1) % self.settings.compact_latest_every == 0:
            self._compact()

    def _try(self, write: Writer, batch: DataFrame, batch_id: int, stage: str,
             record: bool = True) -> bool:
        try:
            write(batch, batch_id)
            return True
        except Exception as problem:
            log.exception("%s failed for batch %d", stage, batch_id)
            if record:
                # The time of the micro-batch, which a retry keeps: no row gets a second date.
                failed_at = F.unix_millis("seen_at") if "seen_at" in batch.columns else None
                self.dead.write(
                    dead_letters(
                        batch, F.lit(stage),
                        F.array(F.lit(f"{stage} failed: {problem}")),
                        F.lit(type(problem).__name__), F.lit(str(problem)), failed_at),
                    batch_id)
            return False

    def _write_routed(self, batch: DataFrame, batch_id: int) -> None:
        rules = [(ROUTED_RAIN_TOPIC, is_rain(self.settings.rain_threshold))]
        files = -(-self._rows // self.settings.archive_rows_per_task)
        # Shuffled: a coalesce would have the few tasks that write read all of the batch.
        routed_messages(batch, rules).repartition(files).write.mode("overwrite") \
            .parquet(f"{self.root}/routed/batch_id={batch_id}")

    def _write_archive(self, batch: DataFrame, batch_id: int) -> None:
        self.archive.write_batch(archive_rows(batch), batch_id, self.settings.archive_rows_per_task,
                                 self.settings.archive_rows_per_file)

    def _write_latest(self, batch: DataFrame, batch_id: int) -> None:
        self.latest.write_batch(batch, batch_id)

    def _compact(self) -> None:
        """After the commit: a failure leaves more deltas, and no row becomes a dead letter."""
        try:
            self.latest.compact()
        except Exception:
            log.exception("compaction of the latest values failed")


def start_fanout(arrivals: DataFrame, sinks: FanOut, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Start the job. ``trigger={"availableNow": True}`` drains what is there."""
    return (
        unique_readings(arrivals, sinks.settings.dedup_horizon, sinks.settings.collapse_copies,
                        keep_time=True)
        .writeStream.queryName("station-fanout").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .foreachBatch(sinks).start()
    )


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows a stateful query dropped as too late. Always 0 for the fan-out, whose watermark
    is the time of the micro-batch; alarm when it is not."""
    dropped = 0
    for progress in query.recentProgress:
        for operator in progress["stateOperators"]:
            dropped += operator.get("numRowsDroppedByWatermark", 0)
    return dropped


def drain(queries: list[StreamingQuery], timeout_s: int | None = 60) -> None:
    """Let running queries finish what has arrived, then stop them. The time is
    per query; None waits until each has drained."""
    for query in queries:
        query.awaitTermination(timeout_s)
        if query.isActive:
            query.stop()
