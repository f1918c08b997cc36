"""Start all station jobs on one session (see ``run_jobs.py``)."""

from __future__ import annotations

import argparse
import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .config import ALERT_JOB_TOPIC, INVALID_TOPIC, READINGS_TOPIC, SILENCE_CHANNEL, PipelineSettings
from .session import build_session, streaming_session
from .sources.arrivals import file_stream, kafka_stream
from .sources.channels import kafka_route_writer
from .streaming import alerts
from .streaming.replay_job import Replayer
from .streaming.silence import silence_alarms
from .streaming.station_job import FanOut, drain, start_fanout


@dataclass
class StationJobs:
    """Independent queries over the same source: alerts, invalid messages, the
    fan-out of accepted readings and, while it runs on, alarms of silent stations.
    Each has its own checkpoint, so one can fail, stop or be replayed without the
    others."""

    spark: SparkSession
    root: str
    settings: PipelineSettings = PipelineSettings()
    bootstrap: str | None = None
    topic: str = READINGS_TOPIC
    files: str | None = None
    roster: str | None = None

    def _arrivals(self) -> DataFrame:
        session = streaming_session(self.spark, self.settings.state_partitions)
        if self.bootstrap:
            return kafka_stream(session, self.bootstrap, topic=self.topic,
                                max_offsets=self.settings.max_offsets,
                                min_partitions=self.settings.min_partitions)
        return file_stream(session, self.files)

    def _channel(self, build: Callable[[DataFrame], DataFrame], name: str, topic: str,
                 trigger: dict) -> StreamingQuery:
        messages, checkpoint = build(self._arrivals()), f"{self.root}/checkpoints/{name}"
        if self.bootstrap:
            return alerts.start_to_kafka(messages, self.bootstrap, topic, checkpoint, name, trigger)
        return alerts.start(messages, f"{self.root}/{topic}", checkpoint, name, trigger)

    def start(self, trigger: dict) -> list[StreamingQuery]:
        route = kafka_route_writer(self.bootstrap) if self.bootstrap else None
        sinks = FanOut(self.spark, self.root, self.settings, route_writer=route)
        queries = [
            self._channel(alerts.alert_stream, "alerts", ALERT_JOB_TOPIC, trigger),
            self._channel(alerts.invalid_stream, "invalid", INVALID_TOPIC, trigger),
            start_fanout(self._arrivals(), sinks, f"{self.root}/checkpoints/fanout", trigger),
        ]
        # Silence means nothing to a job that stops once it has read what is there.
        return queries if "availableNow" in trigger else [*queries, self._alarms(trigger)]

    def _alarms(self, trigger: dict) -> StreamingQuery:
        arrivals = self._arrivals()
        roster = arrivals.sparkSession.read.schema("station_id BIGINT").parquet(self.roster) if self.roster else None
        return alerts.start(
            silence_alarms(arrivals, self.settings.silence_ms, roster), f"{self.root}/{SILENCE_CHANNEL}",
            f"{self.root}/checkpoints/silence", "silence", trigger)


def maintain(spark: SparkSession, root: str, settings: PipelineSettings, replay_dead: bool = False,
             replay_missed: bool = False, date: str | None = None,
             merge_before: datetime.date | None = None) -> dict[str, int]:
    """Replays and merges of a running or stopped job; each is a job of its own beside it."""
    replayer, done = Replayer(spark, root, settings), {}
    if replay_dead:
        done["dead_letters_replayed"] = replayer.replay_dead_letters(date)
    if replay_missed:
        done["missed_replayed"] = replayer.replay_missed(date)
    if merge_before:
        done["merged_version"] = replayer.archive.merge(merge_before, settings.archive_rows_per_file)
    return done


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of archive, stores and checkpoints")
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--bootstrap", help="Kafka bootstrap servers")
    source.add_argument("--files", help="Parquet folder of arrivals")
    parser.add_argument("--horizon", default=PipelineSettings.dedup_horizon)
    parser.add_argument("--state-partitions", type=int, help="partitions of the de-duplication state")
    parser.add_argument("--max-offsets", type=int, default=PipelineSettings.max_offsets,
                        help="messages of a micro-batch")
    parser.add_argument("--min-partitions", type=int, help="read tasks of a micro-batch")
    parser.add_argument("--archive-rows", type=int, default=PipelineSettings.archive_rows_per_file,
                        help="rows of an archive file at most; 0: no bound")
    parser.add_argument("--silence-ms", type=int, default=PipelineSettings.silence_ms,
                        help="alarm when a station was not heard for so long")
    parser.add_argument("--roster", help="Parquet table of the station_ids that should send")
    parser.add_argument("--drain", action="store_true", help="process what is there, then stop")
    parser.add_argument("--replay-dead", action="store_true", help="dead letters back to their sinks")
    parser.add_argument("--replay-missed", action="store_true", help="missed messages to the sinks")
    parser.add_argument("--date", help="replay this date (yyyy-mm-dd) only")
    parser.add_argument("--merge-before", type=datetime.date.fromisoformat,
                        help="rewrite the archive's dates before this one into few files")
    given = parser.parse_args(arguments)
    if not (given.bootstrap or given.files or given.replay_dead or given.replay_missed or given.merge_before):
        parser.error("give a source (--bootstrap or --files), a replay or a merge")
    return given


def settings_of(given: argparse.Namespace) -> PipelineSettings:
    return PipelineSettings(
        dedup_horizon=given.horizon, state_partitions=given.state_partitions,
        max_offsets=given.max_offsets, min_partitions=given.min_partitions,
        archive_rows_per_file=given.archive_rows, silence_ms=given.silence_ms)


def main(arguments: list[str] | None = None) -> None:
    given = parse(arguments)
    spark = build_session("station-jobs")
    settings = settings_of(given)
    done = maintain(spark, given.root, settings, given.replay_dead, given.replay_missed, given.date,
                    given.merge_before)
    for name, value in done.items():
        print(f"{name}: {value}")
    if not (given.bootstrap or given.files):
        return
    jobs = StationJobs(spark, given.root, settings, given.bootstrap, files=given.files, roster=given.roster)
    if given.drain:
        drain(jobs.start({"availableNow": True}), timeout_s=None)
    else:
        jobs.start({"processingTime": "10 seconds"})
        spark.streams.awaitAnyTermination()
