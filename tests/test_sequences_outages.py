"""Block-wise operators against the plain definition, on small data with tiny blocks."""

import random

from pyspark.sql import Window, functions as F

from gaugeline.operators import outages as O, sequences as S

SCHEMA = "station_id BIGINT, s_no BIGINT, status_timestamp BIGINT, kafka_offset BIGINT"


def random_sent(spark, seed):
    rng, rows, offset = random.Random(seed), [], 0
    for station in (1, 2, 3):
        s_no = 0
        for _ in range(200):
            offset += rng.randint(1, 9)
            s_no = 1 if rng.random() < 0.05 else s_no + rng.choice([1, 1, 1, 2, 5, 0])
            rows.append((station, s_no, offset, offset))
    return rows


def brute_runs(rows):
    runs, last = {}, {}
    for station, s_no, _, _ in sorted(rows, key=lambda r: (r[0], r[3])):
        run, before = last.get(station, (0, None))
        if before is None or s_no < before:
            run += 1
        runs.setdefault((station, run), set()).add(s_no)
        last[station] = (run, s_no)
    return {k: (min(v), max(v), len(v), max(v) - min(v) + 1 - len(v)) for k, v in runs.items()}


def brute_gaps(rows):
    gaps, last = [], {}
    for station, s_no, _, _ in sorted(rows, key=lambda r: (r[0], r[3])):
        before = last.get(station)
        if before is not None and s_no - before > 1:
            gaps.append((station, before + 1, s_no - 1, s_no - before - 1))
        last[station] = s_no
    return sorted(gaps)


def test_runs_and_gaps_match_brute_force(spark):
    for seed in range(3):
        rows = random_sent(spark, seed)
        sent = spark.createDataFrame(rows, SCHEMA)
        for width in (3, 50, 1_000_000):
            got = {(r.station_id, r.run): (r.first_s_no, r.last_s_no, r.received, r.lost)
                   for r in S.lost_readings(sent, width).collect()}
            assert got == brute_runs(rows)
            gaps = sorted(tuple(r) for r in S.gap_list(sent, width).collect())
            assert gaps == brute_gaps(rows)


def test_transmissions_drop_copies_but_keep_restarts(spark):
    rows = [(1, 1, 100, 0), (1, 1, 100, 1), (1, 2, 101, 2), (1, 1, 200, 3)]
    sent = S.transmissions(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in sent.collect()) == [
        (1, 1, 100, 0), (1, 1, 200, 3), (1, 2, 101, 2)]


def test_number_rows_equals_row_number(spark):
    rng = random.Random(7)
    rows = [(rng.choice([1, 1, 1, 2, None]), n * rng.randint(1, 3)) for n in range(300)]
    df = spark.createDataFrame(rows, "k INT, o BIGINT").distinct()
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    expected = sorted(map(tuple, plain.collect()), key=repr)
    for width in (10, 1000):
        got = S.number_rows(df, ["k"], ["o"], "n", width)
        assert sorted(map(tuple, got.collect()), key=repr) == expected


def test_key_conflicts(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, "a"), (1, 2, "b")],
                               "station_id INT, s_no INT, value STRING")
    assert [tuple(r) for r in S.key_conflicts(df).collect()] == [(1, 2, 2, 2)]


def beats(spark, rows):
    return spark.createDataFrame(rows, "subscriber STRING, beat_ms BIGINT")


def test_outage_boundaries_are_strict(spark):
    rows = [("a", 0), ("a", 15_000), ("a", 30_001), ("b", 0), ("b", 100_000)]
    got = sorted(tuple(r) for r in O.outage_intervals(beats(spark, rows)).collect())
    assert got == [("a", 30_000, 30_001), ("b", 15_000, 100_000)]
    open_ended = sorted(tuple(r) for r in O.outage_intervals(
        beats(spark, rows), as_of_ms=50_000).collect())
    assert open_ended == [("a", 30_000, 30_001), ("a", 45_001, 50_000), ("b", 15_000, 100_000)]


def test_outages_match_brute_force(spark):
    rng, rows = random.Random(3), []
    for who in "ab":
        at = 0
        for _ in range(400):
            at += rng.choice([1, 50, 99, 100, 101, 250])
            rows.append((who, at))
    expected = []
    for who in "ab":
        times = sorted(t for w, t in rows if w == who)
        expected += [(who, x + 100, y) for x, y in zip(times, times[1:]) if y - x > 100]
    got = sorted(tuple(r) for r in O.outage_intervals(beats(spark, rows), 100).collect())
    assert got == sorted(expected)


def test_health_lists_silent_members(spark):
    roster = spark.createDataFrame([("a",), ("never",)], "subscriber STRING")
    rows = {r.subscriber: (r.last_heartbeat_ms, r.since_last_ms, r.healthy) for r in O.health(
        beats(spark, [("a", 1), ("a", 5)]), F.lit(15_004), roster=roster).collect()}
    assert rows == {"a": (5, 14_999, True), "never": (None, None, False)}
    at_limit = O.health(beats(spark, [("a", 5)]), F.lit(15_005)).first()
    assert at_limit.healthy is False


def test_capture_is_half_open_and_spans_buckets(spark):
    outages = spark.createDataFrame(
        [("0", 1_000, 7_500_000)], "subscriber STRING, down_from_ms BIGINT, down_to_ms BIGINT")
    times = [999, 1_000, 3_600_000, 7_499_999, 7_500_000]
    arrivals = spark.createDataFrame(
        [("k", "v", 0, n, t) for n, t in enumerate(times)],
        "key STRING, value STRING, kafka_partition INT, kafka_offset BIGINT, ms BIGINT"
    ).selectExpr("key", "value", "kafka_partition", "kafka_offset",
                 "timestamp_millis(ms) AS arrival_ts")
    got = O.capture_missed(arrivals, O.outage_spans(outages), F.lit("0"))
    assert sorted(r.kafka_offset for r in got.collect()) == [1, 2, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
