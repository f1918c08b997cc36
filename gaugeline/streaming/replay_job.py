"""Dead letters and missed messages back into the sinks they did not reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import ROUTED_RAIN_TOPIC, PipelineSettings
from ..operators.alerts import is_rain
from ..operators.decode import decode
from ..operators.dedup import DEDUP_KEY, keep_first
from ..operators.replay import dead_letters_as_arrivals, missed_as_arrivals
from ..operators.routing import routed_messages
from ..operators.validate import accepted, is_valid
from ..schemas import ATTEMPT, LEDGER
from ..session import materialise
from ..sources.archive import archive_rows
from ..sources.commits import REPLAY, CommitLog
from ..sources.dead_letters import ID_COLUMNS, DeadLetterStore
from ..sources.latest_store import LatestStore
from ..sources.live_archive import LiveArchive
from ..sources.missed import MissedStore
from ..sources.tables import read_or_empty

STORED, UNUSABLE = "stored", "unusable"


class Replayer:
    """Replays what side channels hold, under one number a run.

    The archive takes only rows it lacks, found by an anti-join with the dates that occur in
    them; latest values go by source offset, so older ones change nothing. The ledger says
    which message reached which sink at which attempt; it is written under the same number
    and committed with the sinks. A run that is interrupted shows nothing and can be
    repeated; a message whose replay was committed is not replayed again.
    """

    def __init__(self, spark: SparkSession, root: str, settings: PipelineSettings = PipelineSettings()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.settings = settings
        self.log = CommitLog(spark, f"{self.root}/commits")
        self.archive = LiveArchive(spark, f"{self.root}/archive", self.log)
        self.latest = LatestStore(spark, f"{self.root}/latest", self.log)
        self.dead = DeadLetterStore(spark, f"{self.root}/dead-letters", self.log)
        self.missed = MissedStore(spark, f"{self.root}/missed")

    # --- the ledger ----------------------------------------------------------------

    def ledger(self) -> DataFrame:
        """Which message was stored, or found unusable, by which replay and at which attempt."""
        rows = read_or_empty(self.spark, f"{self.root}/replay-ledger", LEDGER)
        return self.log.seen(rows, "replay_id", REPLAY)

    def pending_dead_letters(self, date: str | None = None, stage: str | None = None) -> DataFrame:
        done = self.ledger()
        for column, value in (("dl_date", date), ("stage", stage)):
            if value is not None:
                done = done.where(F.col(column) == value)
        return self.dead.read(date, stage).join(done.select(*ID_COLUMNS), ID_COLUMNS, "left_anti")

    def _attempts(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/replay-attempts", ATTEMPT)

    def _try(self, messages: DataFrame, replay_id: int) -> DataFrame:
        """Notes the attempt and returns the messages with its number."""
        messages.select(*ID_COLUMNS, F.lit(replay_id).cast("bigint").alias("replay_id")) \
            .write.mode("append").partitionBy("dl_date", "stage").parquet(f"{self.root}/replay-attempts")
        dates = [r["dl_date"] for r in messages.select("dl_date").distinct().collect()]
        tries = self._attempts().where(F.col("dl_date").isin(dates)).groupBy(*ID_COLUMNS).agg(
            F.count("*").cast("int").alias("attempt"))
        return messages.join(tries, ID_COLUMNS, "left")

    # --- replays ---------------------------------------------------------------------

    def replay_dead_letters(self, date: str | None = None, stage: str | None = None) -> int:
        """Replay the pending dead letters, of one date or stage if given, and count them."""
        dead = materialise(self.pending_dead_letters(date, stage), "replayed-letters")
        count = dead.count()
        if not count:
            return 0
        replay_id = self._next()
        tried = self._try(dead, replay_id)
        bound = decode(dead_letters_as_arrivals(dead, F.current_timestamp()))
        self._store(bound, replay_id)
        usable = bound.select("kafka_partition", "kafka_offset", is_valid().alias("usable")).distinct()
        tried.join(usable, ["kafka_partition", "kafka_offset"], "left").select(
            *ID_COLUMNS, "attempt", F.col("processing_stage").alias("sink"),
            F.when(F.coalesce("usable", F.lit(False)), STORED).otherwise(UNUSABLE).alias("outcome"),
        ).write.mode("overwrite").parquet(f"{self.root}/replay-ledger/replay_id={replay_id}")
        self.log.commit(REPLAY, replay_id)
        self.dead.delete(dead)
        return count

    def replay_missed(self, date: str | None = None) -> int:
        """Replay the pending missed messages, of one date if given, and count them. Those the
        archive lacked go to the routes too."""
        missed = materialise(self.missed.pending(date), "replayed-missed")
        count = missed.count()
        if not count:
            return 0
        replay_id = self._next()
        new = self._store(decode(missed_as_arrivals(missed, F.current_timestamp())), replay_id)
        rules = [(ROUTED_RAIN_TOPIC, is_rain(self.settings.rain_threshold))]
        routed_messages(new, rules).write.mode("overwrite") \
            .parquet(f"{self.root}/routed-replays/replay_id={replay_id}")
        self.log.commit(REPLAY, replay_id)
        # If this is interrupted, the next run finds the rows in the archive and stores none twice.
        self.missed.mark_replayed(missed)
        return count

    def _next(self) -> int:
        return self.log.last(REPLAY) + 1

    def _store(self, decoded: DataFrame, replay_id: int) -> DataFrame:
        """Readings to archive and latest values; returns those the archive lacked."""
        readings = materialise(keep_first(accepted(decoded)), "replayed-readings")
        lacking = materialise(self.archive.missing(archive_rows(readings), list(DEDUP_KEY)), "lacking")
        self.archive.write_replay(lacking, replay_id)
        self.latest.write_batch(readings, replay_id, REPLAY)
        return readings.join(lacking.select(*DEDUP_KEY), list(DEDUP_KEY), "left_semi")


def routed(spark: SparkSession, root: str, log: CommitLog) -> DataFrame:
    """Routed messages of committed micro-batches and replays."""
    base, schema = f"{root.rstrip('/')}/routed", "topic STRING, key STRING, value STRING"
    batches = read_or_empty(spark, base, f"{schema}, batch_id BIGINT")
    replays = read_or_empty(spark, f"{base}-replays", f"{schema}, replay_id BIGINT")
    return log.seen(batches).select("topic", "key", "value").unionByName(
        log.seen(replays, "replay_id", REPLAY).select("topic", "key", "value"))
