"""Every streaming job against its batch twin, plus restarts, retries and failures."""

import pytest
from pyspark.sql import functions as F

from gaugeline.config import PipelineSettings
from gaugeline.operators.decode import decode
from gaugeline.operators.dedup import keep_first
from gaugeline.operators.latest import latest_by_station
from gaugeline.operators.validate import accepted
from gaugeline.session import scratch_path, streaming_session
from gaugeline.sources.archive import read_archive
from gaugeline.sources.arrivals import file_stream, file_table
from gaugeline.jobs import StationJobs
from gaugeline.sources.channels import kafka_sink_options
from gaugeline.streaming import alerts, dedup, silence
from gaugeline.streaming.station_job import (
    FanOut, drain, dropped_by_watermark, start_fanout,
)

DRAIN = {"availableNow": True}
SETTINGS = PipelineSettings(dedup_horizon="60 days", compact_latest_every=2)


@pytest.fixture
def feed(spark, arrivals_of, reading_json):
    """A growing source folder: ``add(rows)`` appends one file."""
    path = scratch_path(spark, "t-feed")

    def add(specs, first_offset):
        texts = [reading_json(station_id=st, s_no=n, weather={"humidity": h})
                 for st, n, h in specs]
        arrivals_of(texts).withColumn("kafka_offset", F.col("kafka_offset") + first_offset) \
            .coalesce(1).write.mode("append").parquet(path)
    return path, add


FIRST = [(1, 1, 50), (1, 2, 80), (2, 1, 90), (1, 2, 80), (2, 2, 130)]
SECOND = [(2, 1, 90), (1, 3, 75), (2, 2, 60), (1, 3, 75)]


def test_restart_neither_loses_nor_repeats(spark, feed):
    path, add = feed
    root = scratch_path(spark, "t-restart")
    for rows, offset in ((FIRST, 0), (SECOND, 100)):
        add(rows, offset)
        query = start_fanout(file_stream(streaming_session(spark), path),
                             FanOut(spark, root, SETTINGS), f"{root}/checkpoint", DRAIN)
        query.awaitTermination()
        assert dropped_by_watermark(query) == 0
    batch = keep_first(accepted(decode(file_table(spark, path))))
    archived = read_archive(spark, f"{root}/archive").select("station_id", "s_no", "humidity")
    wanted = batch.select("station_id", "s_no", "weather.humidity")
    assert sorted(map(tuple, archived.collect())) == sorted(map(tuple, wanted.collect()))
    assert archived.count() == 5
    sinks = FanOut(spark, root, SETTINGS)
    latest = {r.key: r.value for r in sinks.latest.read().collect()}
    assert latest == {r.key: r.value for r in latest_by_station(batch).collect()}
    routed = spark.read.parquet(f"{root}/routed")
    assert sorted(r.key for r in routed.collect()) == ["station-1", "station-1", "station-2"]
    assert sinks.dead.read().count() == 0
    tracked = dedup.tracked_keys(streaming_session(spark), f"{root}/checkpoint")
    assert tracked.count() == 5


def test_a_retried_batch_changes_nothing(spark, feed):
    path, add = feed
    add(FIRST, 0)
    sinks = FanOut(spark, scratch_path(spark, "t-retry"), SETTINGS)
    batch = keep_first(accepted(decode(file_table(spark, path))))
    for _ in range(2):
        sinks(batch, 0)
    assert read_archive(spark, f"{sinks.root}/archive").count() == 3
    assert spark.read.parquet(f"{sinks.root}/routed").count() == 2
    assert sinks.latest.read().count() == 2


def test_copies_collapse_before_the_shuffle(spark, feed):
    path, add = feed
    add([(1, 1, 50)] * 500 + [(1, 2, 80)], 0)
    readings = accepted(decode(file_table(spark, path)))
    rows = dedup.collapse_copies(readings).orderBy("s_no").collect()
    assert [(r.s_no, r.weather.humidity) for r in rows] == [(1, 50), (2, 80)]
    assert rows[0].arrival_ts == readings.orderBy("kafka_offset").first().arrival_ts


def test_large_batches_split_a_directory(spark, feed):
    path, add = feed
    add([(1, n, 50) for n in range(1, 41)], 0)
    settings = PipelineSettings(archive_rows_per_task=5)
    # Micro-batches run without AQE, which would merge these few rows again.
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")
    sinks = FanOut(plain, scratch_path(spark, "t-split"), settings)
    sinks(accepted(decode(file_table(plain, path))), 0)
    table = read_archive(spark, f"{sinks.root}/archive")
    assert table.count() == 40
    assert table.select(F.input_file_name()).distinct().count() > 1


def _broken(batch, batch_id):
    raise OSError("disk full")


def test_failed_sinks_become_dead_letters(spark, feed):
    path, add = feed
    add(FIRST, 0)
    batch = keep_first(accepted(decode(file_table(spark, path))))

    def stages(**writers):
        sinks = FanOut(spark, scratch_path(spark, "t-fail"), SETTINGS, **writers)
        for _ in range(2):
            sinks(batch, 0)
        return sinks, {r.stage: r["count"] for r in sinks.dead.read().groupBy("stage").count().collect()}

    sinks, got = stages(archive_writer=_broken)
    assert got == {"ARCHIVE_WRITE": 3}
    assert sinks.latest.read().count() == 2
    sinks, got = stages(latest_writer=_broken)
    assert got == {"LATEST_WRITE": 3}
    assert read_archive(spark, f"{sinks.root}/archive").count() == 3
    # When both fail, the archive failure alone is recorded.
    assert stages(archive_writer=_broken, latest_writer=_broken)[1] == {"ARCHIVE_WRITE": 3}
    row = sinks.dead.read().first()
    assert row.failure_reasons == ["LATEST_WRITE failed: disk full"]
    assert row.exception_type == "OSError"


def test_failed_route_stops_the_batch(spark, feed):
    path, add = feed
    add(FIRST, 0)
    sinks = FanOut(spark, scratch_path(spark, "t-route"), SETTINGS, route_writer=_broken)
    with pytest.raises(OSError):
        sinks(accepted(decode(file_table(spark, path))), 0)


def test_side_channels(spark, feed):
    path, add = feed
    add(FIRST, 0)
    counts = {}
    for name, build in (("alerts", alerts.alert_stream), ("invalid", alerts.invalid_stream)):
        out = scratch_path(spark, f"t-{name}")
        query = alerts.start(build(file_stream(streaming_session(spark), path)), out,
                             scratch_path(spark, f"t-{name}-cp"), name, DRAIN)
        drain([query])
        counts[name] = spark.read.parquet(out).count()
    # Alerts are neither validated nor de-duplicated.
    assert counts == {"alerts": 4, "invalid": 1}


def test_all_jobs_from_files(spark, feed):
    path, add = feed
    add(FIRST + SECOND, 0)
    root = scratch_path(spark, "t-jobs")
    jobs = StationJobs(spark, root, SETTINGS, files=path)
    for _ in range(2):  # a second run finds nothing new
        drain(jobs.start(DRAIN), timeout_s=None)
    assert spark.read.parquet(f"{root}/raining-alerts").count() == 7
    assert spark.read.parquet(f"{root}/weather-invalid-messages").count() == 1
    assert read_archive(spark, f"{root}/archive").count() == 5


def test_kafka_sinks_are_acknowledged():
    options = kafka_sink_options("host:1", "t")
    assert options["kafka.acks"] == "all" and options["topic"] == "t"
    assert "topic" not in kafka_sink_options("host:1")


def test_silence_is_strict(spark, arrivals_of, reading_json):
    seconds = [0, 60, 121, 400]
    texts = [reading_json(s_no=n) for n in range(len(seconds))] + [reading_json(station_id=2)]
    at = F.element_at(F.array(*[F.lit(s) for s in seconds + [2000]]),
                      (F.col("kafka_offset") + 1).cast("int"))
    path = scratch_path(spark, "t-silence-in")
    arrivals_of(texts).withColumn("arrival_ts", F.timestamp_seconds(at)).write.parquet(path)
    closed = silence.silent_stations(
        file_stream(streaming_session(spark), path), "60 seconds", "10 seconds")
    out = scratch_path(spark, "t-silence")
    alerts.start(closed, out, scratch_path(spark, "t-silence-cp"), "silence", DRAIN) \
        .awaitTermination()
    rows = spark.read.parquet(out).orderBy("last_seen_us").collect()
    assert [(r.station_id, r.readings, r.last_seen_us, r.silent_from_us) for r in rows] == [
        (1, 2, 60_000_000, 120_000_000),
        (1, 1, 121_000_000, 181_000_000),
        (1, 1, 400_000_000, 460_000_000)]
