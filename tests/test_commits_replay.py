"""The commit log, the live archive under it, and replays that reach the sinks."""

import datetime

import pytest
from pyspark.sql import functions as F

from gaugeline.config import PipelineSettings
from gaugeline.jobs import maintain, parse, settings_of
from gaugeline.operators.decode import decode
from gaugeline.operators.dedup import keep_first
from gaugeline.operators.latest import latest_by_station
from gaugeline.operators.outages import missed_rows
from gaugeline.operators.validate import accepted
from gaugeline.session import scratch_path, streaming_session
from gaugeline.sources import live_archive
from gaugeline.sources.archive import archive_rows, read_archive, read_undated, write_archive
from gaugeline.sources.arrivals import file_stream, file_table
from gaugeline.sources.commits import BATCH, MERGE, REPLAY, CommitLog
from gaugeline.sources.dead_letters import DeadLetterStore
from gaugeline.sources.latest_store import LatestStore
from gaugeline.sources.live_archive import LiveArchive, date_folders
from gaugeline.streaming.replay_job import Replayer, routed
from gaugeline.streaming.station_job import FanOut, start_fanout

DAY, START = 86_400, 1_716_076_800  # 2024-05-19 00:00:00 UTC
SETTINGS = PipelineSettings(dedup_horizon="60 days")
KEYS = ["station_id", "s_no"]


@pytest.fixture
def readings(arrivals_of, reading_json):
    """``readings(first, last, stations)``: one reading a quarter of a day and number."""
    def make(first, last, stations=2, **changes):
        texts = [reading_json(station_id=1 + n % stations, s_no=n, weather={"humidity": n % 100},
                              **({"status_timestamp": START + n * DAY // 4} | changes)) for n in range(first, last)]
        return accepted(decode(arrivals_of(texts))).withColumn("kafka_offset", F.col("s_no"))
    return make


def keys(rows):
    return sorted((r.station_id, r.s_no) for r in rows.collect())


def scanned(rows):
    return {r[0] for r in rows.select(F.input_file_name()).distinct().collect()}


def archive(spark, name):
    root = scratch_path(spark, name)
    return LiveArchive(spark, f"{root}/archive", CommitLog(spark, f"{root}/commits"))


# --- the log ---------------------------------------------------------------------------

def test_numbers_only_rise_and_the_log_stays_small(spark):
    log = CommitLog(spark, scratch_path(spark, "t-log"), slots=3)
    assert log.last(BATCH) == -1
    for number in range(8):
        log.commit(BATCH, number)
    log.commit(BATCH, 2)
    assert log.last(BATCH) == 7 and log.last(REPLAY) == -1
    files = spark.read.parquet(f"{log.root}/kind=batch").select("_metadata.file_path").distinct().count()
    assert files == 3


def test_a_batch_is_unseen_until_every_sink_has_it(spark, readings):
    root = scratch_path(spark, "t-killed")

    class Killed(BaseException):
        """Not an error of the sink: the process is gone."""

    def killed(batch, batch_id):
        raise Killed

    whole = FanOut(spark, root, SETTINGS)
    whole(readings(1, 4), 0)
    with pytest.raises(Killed):
        FanOut(spark, root, SETTINGS, latest_writer=killed)(readings(4, 9), 1)
    seen = lambda: (whole.archive.read().count(), routed(spark, root, whole.log).count(),
                    {r.key: r.kafka_offset for r in whole.latest.read().collect()}, whole.dead.read().count())
    first = seen()
    assert first == (3, 0, {"1": 2, "2": 3}, 0)
    assert read_archive(spark, f"{root}/archive").count() == 8  # written, yet not committed
    for _ in range(3):  # the retry, and two more that find it done
        whole(readings(4, 9), 1)
    assert seen() == (8, 0, {"1": 8, "2": 7}, 0)


def test_failed_compaction_makes_no_dead_letters(spark, readings, monkeypatch):
    sinks = FanOut(spark, scratch_path(spark, "t-compact"), PipelineSettings(compact_latest_every=1))
    monkeypatch.setattr(sinks.latest, "compact", lambda: 1 / 0)
    sinks(readings(1, 5), 0)
    assert sinks.dead.read().count() == 0 and sinks.latest.read().count() == 2


def test_late_commits_survive_a_compaction(spark, readings):
    root = scratch_path(spark, "t-latest")
    log = CommitLog(spark, f"{root}/log")
    store = LatestStore(spark, root, log)
    store.write_batch(readings(1, 3), 0)
    log.commit(BATCH, 0)
    store.write_batch(readings(3, 5), 0, REPLAY)  # still open while the other writer compacts
    store.compact()
    assert {r.kafka_offset for r in store.read().collect()} == {1, 2}
    log.commit(REPLAY, 0)
    assert {r.kafka_offset for r in store.read().collect()} == {3, 4}


def test_a_retry_after_midnight_keeps_one_date(spark, readings):
    def broken(batch, batch_id):
        raise OSError("disk full")

    class Killed(BaseException):
        pass

    def killed(batch, batch_id):
        raise Killed

    root = scratch_path(spark, "t-midnight")
    batch = readings(1, 4).withColumn("seen_at", F.lit("2024-05-19 23:59:59").cast("timestamp"))
    with pytest.raises(Killed):
        FanOut(spark, root, SETTINGS, archive_writer=broken, latest_writer=killed)(batch, 0)
    sinks = FanOut(spark, root, SETTINGS, archive_writer=broken)
    assert sinks.dead.read().count() == 0
    sinks(batch, 0)
    assert {r.dl_date: r["count"] for r in sinks.dead.read().groupBy("dl_date").count().collect()} == {
        "2024-05-19": 3}


# --- files and dates -------------------------------------------------------------------

def files_of(rows):
    counts = rows.groupBy("station_id", "day").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()
    return {(r.station_id, r.day): r.n for r in counts}


def test_small_directories_get_one_file_and_a_hot_one_several(spark, readings):
    plain = spark.newSession()
    plain.conf.set("spark.sql.adaptive.enabled", "false")  # as in a micro-batch
    plain.conf.set("spark.sql.shuffle.partitions", "16")
    small = readings(0, 300, stations=100)
    hot = small.where("station_id = 1").limit(1).select(
        "*", F.explode(F.sequence(F.lit(1000), F.lit(1199))).alias("_n")).withColumn(
        "s_no", F.col("_n").cast("bigint")).drop("_n").withColumn("status_timestamp", F.lit(START).cast("bigint"))
    path = scratch_path(spark, "t-files-in")
    archive_rows(small.unionByName(hot)).write.parquet(path)
    store = archive(spark, "t-files")
    store.write_batch(plain.read.parquet(path), 0, rows_per_task=50)
    store.log.commit(BATCH, 0)
    files = files_of(read_archive(spark, store.root))
    assert 1 < files.pop((1, 19)) <= 5  # shares may meet in a task
    assert set(files.values()) == {1}
    assert store.read().count() == 500


def test_rows_without_a_date_break_nothing(spark, readings, arrivals_of, reading_json):
    stamps = [START, 2 ** 63 - 1, 185_542_587_187_199, 185_542_587_187_200, 253_402_300_800]
    rows = archive_rows(accepted(decode(arrivals_of(
        [reading_json(s_no=n, status_timestamp=t) for n, t in enumerate(stamps, 1)]))))
    path = scratch_path(spark, "t-undated")
    write_archive(rows, path)
    assert keys(read_archive(spark, path)) == [(1, 1), (1, 3), (1, 5)]
    assert read_archive(spark, path).where("year = 2024 AND month = 5").count() == 1
    assert {r.year for r in read_archive(spark, path).collect()} == {2024, 5_881_580, 10_000}
    assert sorted(r.status_timestamp for r in read_undated(spark, path).collect()) == [stamps[3], stamps[1]]
    store = archive(spark, "t-undated-live")
    store.write_batch(rows, 0, 100)
    store.log.commit(BATCH, 0)
    for _ in range(2):  # before and after a merge
        assert keys(store.read()) == [(1, 1), (1, 3), (1, 5)]
        assert keys(store.read_undated()) == [(1, 2), (1, 4)]
        assert store.missing(rows, KEYS).count() == 0
        store.merge(datetime.date(2030, 1, 1))


def test_dates_bound_what_is_listed(spark, readings):
    store = archive(spark, "t-dates")
    store.write_batch(archive_rows(readings(0, 40)), 0, 100)
    store.log.commit(BATCH, 0)
    store.write_replay(archive_rows(readings(40, 48)), 0)
    store.log.commit(REPLAY, 0)
    days = (datetime.date(2024, 5, 20), datetime.date(2024, 5, 21))
    rows = store.read(days)
    assert keys(rows) == keys(store.read().where("day IN (20, 21)")) != []
    assert all("day=20" in f or "day=21" in f for f in rows.inputFiles())
    assert len(store.read().inputFiles()) > len(rows.inputFiles()) > 0
    assert store.read((datetime.date(2020, 1, 1), datetime.date(2020, 1, 3))).count() == 0
    assert date_folders((datetime.date(2024, 2, 28), datetime.date(2024, 3, 1))) == [
        "year=2024/month=02/day=28", "year=2024/month=02/day=29", "year=2024/month=03/day=01"]
    assert store.read((datetime.date(2024, 5, 29), datetime.date(2024, 5, 30))).count() == 8


def test_dead_letters_of_a_date_list_that_date(spark, readings):
    from gaugeline.operators.envelopes import dead_letters
    store = DeadLetterStore(spark, scratch_path(spark, "t-dl-dates"))
    failed = dead_letters(readings(0, 12), F.when(F.col("s_no") % 2 == 0, "ARCHIVE_WRITE"), F.array(F.lit("x")),
                          F.lit("E"), F.lit("m"), F.col("status_timestamp") * 1000)
    store.write(failed)
    one = store.read("2024-05-20")
    assert one.count() == 4
    assert {f.split("/messages/")[1].split("/")[0] for f in one.inputFiles()} == {"dl_date=2024-05-20"}
    assert store.read("2024-05-20", "ARCHIVE_WRITE").count() == 2
    assert store.read(stage="UNKNOWN").count() == 6
    assert store.read("1999-01-01").count() == 0
    store.delete(one)
    assert store.read("2024-05-20").count() == 0 and store.read().count() == 8


# --- merges ----------------------------------------------------------------------------

def test_merge_rewrites_touched_dates_only(spark, readings):
    store = archive(spark, "t-merge")
    batches = [readings(0, 12), readings(12, 16).unionByName(readings(1, 2).withColumn("s_no", F.lit(901).cast("bigint")))]
    store.write_batch(archive_rows(batches[0]), 0, 100)
    store.log.commit(BATCH, 0)
    assert store.merge(datetime.date(2024, 5, 21)) == 0  # 19 and 20 May
    merged = store.snapshot().merged
    assert set(merged) == {20240519, 20240520} and store.touched() == [20240521]
    store.write_batch(archive_rows(batches[1]), 1, 100)
    store.log.commit(BATCH, 1)
    wanted = keys(batches[0].unionByName(batches[1]))
    assert keys(store.read()) == wanted
    # The late row touches 19 May again; 20 May keeps its files.
    assert store.touched() == [20240519, 20240521, 20240522]
    assert store.merge(datetime.date(2024, 6, 1)) == 1
    state = store.snapshot().merged
    assert {d: m.version for d, m in state.items()} == {20240519: 1, 20240520: 0, 20240521: 1, 20240522: 1}
    assert keys(store.read()) == wanted and store.touched() == []
    assert store.merge(datetime.date(2024, 6, 1)) is None
    files = scanned(store.read())
    assert all("archive-merged" in f for f in files) and len(files) == 8
    one = store.read((datetime.date(2024, 5, 20), datetime.date(2024, 5, 20)))
    assert all("version=0" in f for f in scanned(one)) and one.count() == 4


def test_an_interrupted_merge_changes_nothing(spark, readings, monkeypatch):
    store = archive(spark, "t-merge-cut")
    store.write_batch(archive_rows(readings(0, 12)), 0, 100)
    store.log.commit(BATCH, 0)
    before = keys(store.read())
    monkeypatch.setattr(store.log, "commit", lambda kind, number: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.merge(datetime.date(2024, 6, 1))
    monkeypatch.undo()
    assert store.log.last(MERGE) == -1 and keys(store.read()) == before
    assert all("archive-merged" not in f for f in scanned(store.read()))
    store.write_batch(archive_rows(readings(12, 14)), 1, 100)
    store.log.commit(BATCH, 1)
    assert store.merge(datetime.date(2024, 5, 20)) == 0
    assert keys(store.read()) == sorted([*before, (1, 12), (2, 13)])


def test_a_batch_committed_during_a_merge_is_seen_once(spark, readings, monkeypatch):
    store = archive(spark, "t-merge-race")
    store.write_batch(archive_rows(readings(0, 8)), 0, 100)
    store.log.commit(BATCH, 0)
    real = live_archive.write_archive

    def late(*args, **kwargs):
        store.log.commit(BATCH, 1)
        real(*args, **kwargs)
    store.write_batch(archive_rows(readings(0, 3).withColumn("s_no", F.col("s_no") + 500)), 1, 100)
    monkeypatch.setattr(live_archive, "write_archive", late)
    store.merge(datetime.date(2024, 6, 1))
    assert keys(store.read()) == keys(readings(0, 8).unionByName(
        readings(0, 3).withColumn("s_no", F.col("s_no") + 500)))


# --- replays ---------------------------------------------------------------------------

def test_dead_letters_return_to_their_sinks(spark, readings, arrivals_of, reading_json):
    feed, root = scratch_path(spark, "t-feed"), scratch_path(spark, "t-replay")
    for start in (1, 11, 21):
        texts = [reading_json(station_id=1 + n % 3, s_no=n, status_timestamp=START + n * DAY // 4,
                              weather={"humidity": 60 + n}) for n in range(start, start + 10)]
        arrivals_of(texts).withColumn("kafka_offset", F.col("kafka_offset") + start).coalesce(1) \
            .write.mode("append").parquet(feed)
    whole = FanOut(spark, root, SETTINGS)

    def failing(write, batches):
        def attempt(batch, batch_id):
            if batch_id in batches:
                raise OSError("disk full")
            write(batch, batch_id)
        return attempt
    broken = FanOut(spark, root, SETTINGS, archive_writer=failing(whole._archive, {0, 2}),
                    latest_writer=failing(whole._latest, {1, 2}))
    start_fanout(file_stream(streaming_session(spark), feed, 1), broken, f"{root}/checkpoint",
                 {"availableNow": True}).awaitTermination()
    replayer = Replayer(spark, root, SETTINGS)
    assert whole.archive.read().count() == 10
    assert replayer.pending_dead_letters().groupBy("stage").count().orderBy("stage").collect() == [
        ("ARCHIVE_WRITE", 20), ("LATEST_WRITE", 10)]
    assert replayer.replay_dead_letters(stage="LATEST_WRITE") == 10
    assert replayer.pending_dead_letters().count() == 20
    assert replayer.replay_dead_letters() == 20
    assert replayer.replay_dead_letters() == 0
    batch = keep_first(accepted(decode(file_table(spark, feed))))
    assert keys(replayer.archive.read()) == keys(batch)
    assert replayer.archive.read().exceptAll(archive_rows(batch)).count() == 0
    assert {r.key: r.value for r in replayer.latest.read().collect()} == {
        r.key: r.value for r in latest_by_station(batch).collect()}
    assert replayer.pending_dead_letters().count() == replayer.dead.read().count() == 0
    ledger = replayer.ledger().groupBy("sink", "outcome", "attempt", "replay_id").count().orderBy("sink").collect()
    assert [tuple(r) for r in ledger] == [("ARCHIVE_WRITE", "stored", 1, 1, 20), ("LATEST_WRITE", "stored", 1, 0, 10)]


def test_an_interrupted_replay_shows_nothing_and_counts_as_an_attempt(spark, readings, monkeypatch):
    def broken(batch, batch_id):
        raise OSError("disk full")
    root = scratch_path(spark, "t-replay-cut")
    FanOut(spark, root, SETTINGS, archive_writer=broken)(readings(1, 6), 0)
    replayer = Replayer(spark, root, SETTINGS)
    monkeypatch.setattr(replayer.log, "commit", lambda kind, number: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        replayer.replay_dead_letters()
    monkeypatch.undo()
    assert replayer.archive.read().count() == 0 and replayer.pending_dead_letters().count() == 5
    assert replayer.replay_dead_letters() == 5
    assert replayer.archive.read().count() == 5
    assert {r.attempt for r in replayer.ledger().collect()} == {2}


def test_a_committed_replay_is_not_repeated_if_the_delete_is_lost(spark, readings, monkeypatch):
    def broken(batch, batch_id):
        raise OSError("disk full")
    root = scratch_path(spark, "t-replay-del")
    FanOut(spark, root, SETTINGS, archive_writer=broken)(readings(1, 6), 0)
    replayer = Replayer(spark, root, SETTINGS)
    monkeypatch.setattr(replayer.dead, "delete", lambda rows: None)
    assert [replayer.replay_dead_letters(), replayer.replay_dead_letters()] == [5, 0]
    assert replayer.archive.read().count() == 5


def test_unusable_letters_are_not_pending_for_ever(spark, readings):
    from gaugeline.operators.envelopes import dead_letters
    root = scratch_path(spark, "t-unusable")
    replayer = Replayer(spark, root, SETTINGS)
    bad = readings(1, 3).withColumn("value", F.lit("not json"))
    replayer.dead.write(dead_letters(bad, F.lit("ARCHIVE_WRITE"), F.array(F.lit("x")), F.lit("E"), F.lit("m")))
    assert [replayer.replay_dead_letters(), replayer.replay_dead_letters()] == [2, 0]
    assert {r.outcome for r in replayer.ledger().collect()} == {"unusable"}


def test_missed_messages_reach_the_sinks_once(spark, readings):
    root = scratch_path(spark, "t-missed-replay")
    sinks = FanOut(spark, root, SETTINGS)
    every = readings(66, 78)
    sinks(every.where("s_no % 3 = 0"), 0)
    replayer = Replayer(spark, root, SETTINGS)
    # One message was missed and yet arrived by another way.
    replayer.missed.write(missed_rows(every.where("s_no % 3 > 0 OR s_no = 72").withColumns({
        "arrived_ms": F.col("status_timestamp") * 1000, "down_from_ms": F.lit(START * 1000)})))
    assert replayer.replay_missed("2024-06-05") == 3
    assert replayer.replay_missed() == 6 and replayer.replay_missed() == 0
    assert keys(replayer.archive.read()) == keys(every)
    assert routed(spark, root, replayer.log).count() == every.where("weather.humidity > 70").count()
    assert {r.kafka_offset for r in replayer.latest.read().collect()} == {76, 77}
    assert replayer.missed.pending().count() == 0


def test_job_options(spark, readings):
    given = parse(["--root", "r", "--bootstrap", "h:1", "--state-partitions", "7", "--max-offsets", "10000",
                   "--min-partitions", "64", "--archive-rows", "10000", "--horizon", "1 hour"])
    assert settings_of(given) == PipelineSettings(
        dedup_horizon="1 hour", state_partitions=7, max_offsets=10_000, min_partitions=64,
        archive_rows_per_file=10_000)
    with pytest.raises(SystemExit):
        parse(["--root", "r"])
    root = scratch_path(spark, "t-maintain")

    def broken(batch, batch_id):
        raise OSError("disk full")
    FanOut(spark, root, SETTINGS, archive_writer=broken)(readings(1, 6), 0)
    given = parse(["--root", root, "--replay-dead", "--replay-missed", "--merge-before", "2024-06-01"])
    assert maintain(spark, root, SETTINGS, given.replay_dead, given.replay_missed, given.date, given.merge_before) == {
        "dead_letters_replayed": 5, "missed_replayed": 0, "merged_version": 0}
    sinks = FanOut(spark, root, PipelineSettings(archive_rows_per_file=2))
    sinks(readings(100, 104, stations=1, status_timestamp=START + 50 * DAY), 1)
    files = files_of(read_archive(spark, f"{root}/archive"))
    assert files == {(1, 8): 2}
