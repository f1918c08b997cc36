"""Stateful processors: alarms by the clock, and the receiver with commands and conflicts."""

import time

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.decode import decode
from gaugeline.operators.sequences import key_conflicts
from gaugeline.operators.validate import accepted
from gaugeline.session import scratch_path, streaming_session
from gaugeline.sources.arrivals import file_stream, file_table
from gaugeline.streaming import alerts
from gaugeline.streaming.receiver import COMMAND, received, remembered
from gaugeline.streaming.silence import ALARM, silence_alarms

DRAIN = {"availableNow": True}
HOUR_MS = 3_600_000


@pytest.fixture
def feed(spark, arrivals_of, reading_json):
    path = scratch_path(spark, "t-state-feed")

    def add(specs, first_offset):
        texts = [reading_json(station_id=st, s_no=n, weather={"humidity": h}) for st, n, h in specs]
        arrivals_of(texts).withColumn("kafka_offset", F.col("kafka_offset") + first_offset) \
            .coalesce(1).write.mode("append").parquet(path)
    return path, add


def wait_for(found, seconds=60):
    end = time.time() + seconds
    while not found():
        assert time.time() < end
        time.sleep(0.5)


def test_alarms_go_off_when_the_whole_feed_stops(spark, feed):
    path, add = feed
    add([(1, 1, 50), (1, 2, 50), (2, 1, 50), (9, 1, 500)], 0)  # station 9 sends nothing valid
    session = streaming_session(spark, 2)
    roster = session.createDataFrame([(1,), (7,)], "station_id BIGINT")
    out = scratch_path(spark, "t-alarms")
    query = alerts.start(silence_alarms(file_stream(session, path), 3_000, roster), out,
                         scratch_path(spark, "t-alarms-cp"), "alarms", {"processingTime": "500 milliseconds"})
    try:
        heard = lambda: {(r.station_id, r.readings) for r in
                         spark.read.schema(ALARM).parquet(out).collect()}
        wait_for(lambda: heard() >= {(1, 2), (2, 1), (7, 0)})
        add([(2, 2, 50)], 10)  # heard again: silent again later, and once
        wait_for(lambda: (2, 2) in heard())
        time.sleep(4)
    finally:
        query.stop()
    rows = spark.read.schema(ALARM).parquet(out).collect()
    assert sorted((r.station_id, r.readings) for r in rows) == [(1, 2), (2, 1), (2, 2), (7, 0)]
    assert {r.last_seen_us is None for r in rows if r.station_id == 7} == {True}


def run(spark, arrivals, commands, checkpoint, out):
    session = streaming_session(spark, 2)
    control = session.readStream.schema(COMMAND).parquet(commands)
    alerts.start(received(file_stream(session, arrivals), control, HOUR_MS), out, checkpoint, "receiver", DRAIN) \
        .awaitTermination(120)
    rows = spark.read.parquet(out)
    return sorted((r.outcome, r.station_id, r.s_no) for r in rows.collect())


def test_forgotten_messages_are_accepted_once_more(spark, feed):
    path, add = feed
    commands, out, cp = (scratch_path(spark, n) for n in ("t-cmd", "t-cmd-out", "t-cmd-cp"))

    def command(*rows):
        spark.createDataFrame(rows, COMMAND).coalesce(1).write.mode("append").parquet(commands)
    add([(1, 1, 50), (1, 2, 60), (2, 1, 70), (1, 1, 50)], 0)
    command(("unknown", 1, 1))
    first = [("accepted", 1, 1), ("accepted", 1, 2), ("accepted", 2, 1)]
    assert run(spark, path, commands, cp, out) == first
    assert sorted(tuple(r)[:2] for r in remembered(streaming_session(spark), cp).collect()) == [(1, 1), (1, 2), (2, 1)]
    command(("forget", 1, 2), ("forget", 5, 5))
    again = [(1, 1, 50), (1, 2, 60), (2, 1, 70)]
    add(again * 2, 10)
    second = sorted([*first, ("forgotten", 1, 2), ("accepted", 1, 2)])
    assert run(spark, path, commands, cp, out) == second
    command(("clear", 1, None))
    add(again, 20)
    assert run(spark, path, commands, cp, out) == sorted(
        [*second, ("forgotten", 1, 1), ("forgotten", 1, 2), ("accepted", 1, 1), ("accepted", 1, 2)])
    assert run(spark, path, commands, cp, out) == run(spark, path, commands, cp, out)


def test_conflicts_equal_the_batch_report(spark, feed):
    path, add = feed
    out, cp = scratch_path(spark, "t-conf-out"), scratch_path(spark, "t-conf-cp")
    add([(1, 1, 50), (1, 2, 60), (1, 2, 61), (1, 2, 60)], 0)
    session = streaming_session(spark, 2)
    for offset, rows in ((0, []), (10, [(1, 1, 50), (1, 1, 51), (1, 1, 52), (1, 1, 51), (2, 1, 50)])):
        if rows:
            add(rows, offset)
        alerts.start(received(file_stream(session, path), None, HOUR_MS), out, cp, "conflicts", DRAIN).awaitTermination(120)
    rows = spark.read.parquet(out).where("outcome = 'conflict'").groupBy("station_id", "s_no").agg(
        (F.count_distinct("value") + 1).alias("payloads"))
    wanted = key_conflicts(accepted(decode(file_table(spark, path)))).select("station_id", "s_no", "payloads")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, wanted.collect())) == [(1, 1, 3), (1, 2, 2)]
