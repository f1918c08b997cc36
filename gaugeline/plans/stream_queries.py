"""Registered streaming queries: each drains the derived arrivals and reads back
what its sinks hold, to be compared with the batch result."""

from __future__ import annotations

import datetime
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import PipelineSettings
from ..operators.decode import decode
from ..operators.dedup import DEDUP_KEY, keep_first
from ..operators.outages import missed_rows
from ..operators.validate import accepted
from ..schemas import ARCHIVE_COLUMNS
from ..session import scratch_path, streaming_session
from ..sources.archive import read_archive
from ..sources.arrivals import file_stream
from ..sources.dead_letters import DeadLetterStore
from ..sources.latest_store import LatestStore
from ..streaming import alerts, dedup, receiver, silence
from ..streaming.replay_job import Replayer, routed
from ..streaming.station_job import FanOut, start_fanout
from . import fixtures as fx
from .queries import query

SETTINGS = PipelineSettings()
DRAIN = {"availableNow": True}
SILENCE_MS = 10_000
HORIZON_MS = 6 * 3_600_000
MERGE_BEFORE = datetime.date(2024, 1, 20)


def _source(spark: SparkSession, sf_dir: str, eighths: int | None = None) -> DataFrame:
    """The feed, in micro-batches of some eighths of it if given."""
    return _feed(spark, fx.feed_path(spark, sf_dir), eighths and fx.batch_files(spark, sf_dir, eighths))


def _feed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    session = streaming_session(spark, spark.sparkContext.defaultParallelism)
    return file_stream(session, path, files_per_batch)


def _to_table(spark: SparkSession, messages: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    alerts.start(messages, path, scratch_path(spark, f"{name}-checkpoint"), name, DRAIN) \
        .awaitTermination()
    return spark.read.schema(messages.schema).parquet(path)


def _fanout_root(spark: SparkSession, sf_dir: str) -> str:
    def run(root: str) -> None:
        start_fanout(_source(spark, sf_dir, eighths=4), FanOut(spark, root, SETTINGS),
                     f"{root}/checkpoint", DRAIN).awaitTermination()
    return fx.once(spark, sf_dir, "fanout", run)


@query
def stream_alerts(spark, sf_dir):
    return _to_table(spark, alerts.alert_stream(_source(spark, sf_dir)), "stream-alerts")


@query
def stream_invalid(spark, sf_dir):
    sent = _to_table(spark, alerts.invalid_stream(_source(spark, sf_dir)), "stream-invalid")
    return sent.select(
        F.get_json_object("value", "$.kafka_offset").cast("bigint").alias("kafka_offset"),
        F.get_json_object("value", "$.original_message").alias("original_message"))


@query
def stream_dedup(spark, sf_dir):
    readings = dedup.unique_readings(_source(spark, sf_dir, eighths=4), SETTINGS.dedup_horizon)
    return _to_table(spark, readings.select(*DEDUP_KEY, "value"), "stream-dedup")


@query
def stream_fanout(spark, sf_dir):
    return read_archive(spark, f"{_fanout_root(spark, sf_dir)}/archive").select(*ARCHIVE_COLUMNS)


@query
def stream_routed(spark, sf_dir):
    return spark.read.schema("topic STRING, key STRING, value STRING") \
        .parquet(f"{_fanout_root(spark, sf_dir)}/routed").select("topic", "key", "value")


@query
def stream_latest(spark, sf_dir):
    return LatestStore(spark, f"{_fanout_root(spark, sf_dir)}/latest").read() \
        .select("key", "value")


@query
def stream_state(spark, sf_dir):
    """Keys the de-duplication of the fan-out job still remembers."""
    root = _fanout_root(spark, sf_dir)
    return dedup.tracked_keys(streaming_session(spark), f"{root}/checkpoint") \
        .select("station_id", "s_no")


@query
def stream_dlq(spark, sf_dir):
    """The archive sink fails throughout: every accepted reading is a dead letter."""
    def broken(batch: DataFrame, batch_id: int) -> None:
        raise OSError("disk full")

    root = scratch_path(spark, "fanout-broken")
    start_fanout(_source(spark, sf_dir), FanOut(spark, root, SETTINGS, archive_writer=broken),
                 f"{root}/checkpoint", DRAIN).awaitTermination()
    return DeadLetterStore(spark, f"{root}/dead-letters").read().select(
        "stage", "exception_type", "exception_message", "station_id", "sequence_number",
        "original_message", F.element_at("failure_reasons", 1).alias("reason"))


@query
def stream_late(spark, sf_dir):
    """Every eighth of the feed is older than the one before, and none of its rows is lost."""
    readings = dedup.unique_readings(_feed(spark, fx.late_feed_path(spark, sf_dir),
                                           fx.batch_files(spark, sf_dir, 1)), SETTINGS.dedup_horizon)
    return _to_table(spark, readings.select(*DEDUP_KEY, "value"), "stream-late")


def _replayed_root(spark: SparkSession, sf_dir: str) -> str:
    """A fan-out whose archive fails for odd batches and latest values for the third, after
    which the dead letters are replayed twice and the closed dates merged."""
    def run(root: str) -> None:
        sinks = FanOut(spark, root, SETTINGS)
        archive, latest = sinks._archive, sinks._latest

        def failing(write, fails):
            def attempt(batch: DataFrame, batch_id: int) -> None:
                if fails(batch_id):
                    raise OSError("disk full")
                write(batch, batch_id)
            return attempt
        broken = FanOut(spark, root, SETTINGS, archive_writer=failing(archive, lambda n: n % 2 == 1),
                        latest_writer=failing(latest, lambda n: n == 2))
        start_fanout(_source(spark, sf_dir, eighths=2), broken, f"{root}/checkpoint", DRAIN) \
            .awaitTermination()
        replayer = Replayer(spark, root, SETTINGS)
        counts = [replayer.pending_dead_letters().count(), replayer.replay_dead_letters(),
                  replayer.replay_dead_letters(), replayer.pending_dead_letters().count()]
        replayer.archive.merge(MERGE_BEFORE)
        spark.createDataFrame([tuple(counts)], "failed BIGINT, first BIGINT, second BIGINT, pending BIGINT") \
            .write.parquet(f"{root}/counts")
    return fx.once(spark, sf_dir, "fanout-replayed", run)


@query
def stream_replay(spark, sf_dir):
    """The archive after failures, replays and a merge: as if nothing had failed."""
    return Replayer(spark, _replayed_root(spark, sf_dir), SETTINGS).archive.read().select(*ARCHIVE_COLUMNS)


@query
def stream_replay_latest(spark, sf_dir):
    return Replayer(spark, _replayed_root(spark, sf_dir), SETTINGS).latest.read().select("key", "value")


@query
def stream_replay_ledger(spark, sf_dir):
    """What the ledger says of the dead letters, next to what the two runs counted."""
    root = _replayed_root(spark, sf_dir)
    letters = Replayer(spark, root, SETTINGS).ledger().groupBy("outcome", "attempt").agg(
        F.count_distinct("kafka_partition", "kafka_offset", "sink").alias("letters"))
    runs = spark.read.parquet(f"{root}/counts")
    return letters.join(runs, F.col("letters") == F.col("first")).select(
        "outcome", "attempt", (F.col("failed") > 0).alias("some_failed"),
        (F.col("first") == F.col("failed")).alias("all_replayed"), F.col("second").alias("second_run"), "pending")


@query
def stream_missed_replay(spark, sf_dir):
    """A job that missed what came during outages, after the missed messages were replayed."""
    def run(root: str) -> None:
        ids = ["kafka_partition", "kafka_offset"]
        caught = fx.arrivals(spark, sf_dir).join(fx.captured(spark, sf_dir).select(*ids), ids, "left_anti")
        sinks = FanOut(spark, root, SETTINGS)
        sinks(keep_first(accepted(decode(caught))), 0)
        replayer = Replayer(spark, root, SETTINGS)
        replayer.missed.write(missed_rows(fx.captured(spark, sf_dir)))
        for _ in range(2):
            replayer.replay_missed()
    root = fx.once(spark, sf_dir, "missed-replayed", run)
    replayer = Replayer(spark, root, SETTINGS)
    routed_keys = routed(spark, root, replayer.log).groupBy("key").agg(F.count("*").alias("routed"))
    return replayer.archive.read().groupBy("station_id").agg(
        F.count("*").alias("readings"), F.sum("s_no").alias("sum_s_no")).withColumn(
        "key", F.concat(F.lit("station-"), F.col("station_id").cast("string"))).join(
        routed_keys, "key", "left").select("station_id", "readings", "sum_s_no", "routed")


@query
def stream_silent(spark, sf_dir):
    closed = silence.silent_stations(_source(spark, sf_dir), "4 hours", "1 hour")
    return _to_table(spark, closed, "stream-silent")


@query
def stream_silent_clock(spark, sf_dir):
    """Alarms by the clock after the whole feed has stopped; stations 11 and 12 never send.

    A station may also be reported while the feed still runs, if a micro-batch takes long;
    the last report of each has all its readings.
    """
    session = streaming_session(spark, spark.sparkContext.defaultParallelism)
    roster = session.range(1, fx.STATIONS + 3).select(F.col("id").alias("station_id"))
    path = scratch_path(spark, "stream-silent-clock")
    alarms = alerts.start(
        silence.silence_alarms(_feed(spark, fx.feed_path(spark, sf_dir),
                                     fx.batch_files(spark, sf_dir, 2)), SILENCE_MS, roster), path,
        scratch_path(spark, "stream-silent-clock-checkpoint"), "stream-silent-clock",
        {"processingTime": "1 second"})
    try:
        deadline = time.time() + 600
        sent = fx.arrivals(spark, sf_dir).count()
        while sum(p["numInputRows"] for p in alarms.recentProgress) < sent and time.time() < deadline:
            time.sleep(0.5)
        stopped_ms = int(time.time() * 1000)
        # Every station's timer runs out within the silence, plus one trigger.
        reported = lambda: spark.read.schema(silence.ALARM).parquet(path).where(
            (F.col("silent_at_ms") > stopped_ms - SILENCE_MS) & (F.col("station_id") <= fx.STATIONS)) \
            .select("station_id").distinct().count()
        deadline = time.time() + 10 * SILENCE_MS / 1000
        while reported() < fx.STATIONS and time.time() < deadline:
            time.sleep(1)
    finally:
        alarms.stop()
    rows = spark.read.schema(silence.ALARM).parquet(path)
    return rows.groupBy("station_id").agg(
        F.max("readings").alias("readings"), F.max("last_seen_us").alias("last_seen_us"))


def _receive(spark: SparkSession, arrivals_path: str, commands: str | None, name: str, out: str,
             checkpoint: str, files: int | None = None) -> None:
    session = streaming_session(spark, spark.sparkContext.defaultParallelism)
    control = session.readStream.schema(receiver.COMMAND).parquet(commands) if commands else None
    alerts.start(receiver.received(file_stream(session, arrivals_path, files), control, HORIZON_MS),
                 out, checkpoint, name, DRAIN).awaitTermination()


@query
def stream_conflicts(spark, sf_dir):
    """Keys that come again with another payload, reported as they come."""
    out = scratch_path(spark, "stream-conflicts")
    _receive(spark, fx.misnamed_feed_path(spark, sf_dir), None, "stream-conflicts", out,
             scratch_path(spark, "stream-conflicts-checkpoint"), fx.batch_files(spark, sf_dir, 2))
    rows = spark.read.schema(receiver.OUTCOME).parquet(out).where(F.col("outcome") == receiver.CONFLICT)
    return rows.groupBy("station_id", "s_no").agg((F.count_distinct("value") + 1).alias("payloads"))


@query
def stream_forget(spark, sf_dir):
    """All readings; then every 50th is forgotten, and station 3 cleared; then all come again."""
    root = scratch_path(spark, "stream-forget")
    arrivals, commands, out = f"{root}/arrivals", f"{root}/commands", f"{root}/outcomes"
    rows = fx.arrivals(spark, sf_dir)
    forget = fx.unique(spark, sf_dir).where("s_no % 50 = 0").select(
        F.lit(receiver.FORGET).alias("command"), "station_id", "s_no")
    clear = spark.range(1).select(F.lit(receiver.CLEAR).alias("command"), F.lit(3).cast("bigint").alias("station_id"),
                                  F.lit(None).cast("bigint").alias("s_no"))
    spark.createDataFrame([], receiver.COMMAND).write.parquet(commands)
    for number, feed in enumerate((rows, None, rows)):
        if feed is None:
            forget.unionByName(clear).write.mode("append").parquet(commands)
        else:
            feed.withColumn("kafka_offset", F.col("kafka_offset") + number * 10 ** 12).write.mode("append") \
                .parquet(arrivals)
        _receive(spark, arrivals, commands, "stream-forget", out, f"{root}/checkpoint")
    return spark.read.schema(receiver.OUTCOME).parquet(out).groupBy("station_id", "outcome").agg(
        F.count("*").alias("messages"), F.sum("s_no").alias("sum_s_no"))
