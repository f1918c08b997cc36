import pytest
from pyspark.sql import functions as F

from gaugeline.operators import browse
from gaugeline.operators.decode import decode
from gaugeline.operators.envelopes import dead_letters, invalid_messages
from gaugeline.operators.forecast import normalise_responses
from gaugeline.operators.outages import missed_rows
from gaugeline.operators.replay import dead_letters_as_arrivals, missed_as_arrivals
from gaugeline.operators.routing import routes
from gaugeline.operators.validate import accepted, rejected
from gaugeline.schemas import ARCHIVE_COLUMNS
from gaugeline.session import scratch_path
from gaugeline.sources.archive import archive_rows, compact_archive, read_archive, write_archive
from gaugeline.sources.arrivals import from_kafka_columns, kafka_options
from gaugeline.sources.dead_letters import DeadLetterStore
from gaugeline.sources.missed import MissedStore

DAY = 86_400
START = 1716076800  # 2024-05-19 00:00:00 UTC


@pytest.fixture
def readings(arrivals_of, reading_json):
    texts = [reading_json(s_no=n, station_id=1 + n % 3, status_timestamp=START + n * DAY // 4,
                          weather={"humidity": 10 * n}) for n in range(1, 9)]
    return accepted(decode(arrivals_of(texts)))


def letters(readings, failed_at=None):
    failed_at = F.lit(START * 1000) if failed_at is None else failed_at
    return dead_letters(
        readings, F.when(F.col("s_no") % 2 == 0, "ARCHIVE_WRITE"),
        F.array(F.lit("first"), F.lit("second")),
        F.when(F.col("s_no") > 2, "SomeVeryLongExceptionName"), F.lit("why"), failed_at)


def test_archive_layout_and_pruning(spark, readings):
    path = scratch_path(spark, "t-archive")
    write_archive(archive_rows(readings), path)
    table = read_archive(spark, path)
    assert table.count() == 8
    assert dict(table.select(*ARCHIVE_COLUMNS).dtypes) == {
        "station_id": "bigint", "s_no": "bigint", "battery_status": "string",
        "status_timestamp": "bigint", "humidity": "int", "temperature": "int",
        "wind_speed": "int", "year": "int", "month": "int", "day": "int"}
    files = [r[0] for r in table.select(F.input_file_name()).distinct().collect()]
    assert all("/year=2024/month=05/day=" in name for name in files)
    one = table.where("year = 2024 AND month = 5 AND day = 19 AND station_id = 2 AND humidity > 5")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThan(humidity,5)" in plan
    assert one.count() == 1
    # Every row lies under its own date.
    assert table.where("day <> day(timestamp_seconds(status_timestamp))").count() == 0


def test_archive_batch_retry_and_compaction(spark, readings):
    path, merged = scratch_path(spark, "t-arch-b"), scratch_path(spark, "t-arch-m")
    rows = archive_rows(readings)
    write_archive(rows.where("s_no <= 4"), path, 0)
    for _ in range(2):
        write_archive(rows.where("s_no > 4"), path, 1, splits=3)
    assert read_archive(spark, path).count() == 8
    compact_archive(spark, path, merged)
    assert read_archive(spark, merged).select(*ARCHIVE_COLUMNS).exceptAll(
        rows.select(*ARCHIVE_COLUMNS)).count() == 0


def test_huge_timestamp_does_not_break_the_archive(arrivals_of, reading_json):
    rows = archive_rows(accepted(decode(arrivals_of(
        [reading_json(status_timestamp=9_000_000_000_000_000_000)]))))
    assert rows.first().year is None


def test_dead_letter_store(spark, readings):
    store = DeadLetterStore(spark, scratch_path(spark, "t-dlq"))
    assert store.read().count() == 0
    for _ in range(2):
        store.write(letters(readings), batch_id=3)
    assert store.read().count() == 8
    store.write(letters(readings.where("s_no = 1"), F.lit((START + DAY) * 1000)))
    assert store.read("2024-05-19").count() == 8
    assert store.read("2024-05-19", "UNKNOWN").count() == 4
    assert store.read("1999-01-01").count() == 0
    plan = store.read("2024-05-19", "UNKNOWN")._jdf.queryExecution().executedPlan().toString()
    assert "dl_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert store.by_station(2).count() == 4
    doomed = store.read().where("kafka_offset = 0")
    assert doomed.count() == 2
    store.delete(doomed.where("dl_date = '2024-05-20'"))
    assert store.read("2024-05-20").count() == 0
    assert store.read("2024-05-19").count() == 8
    fresh = store.vacuum(scratch_path(spark, "t-dlq-v"))
    assert fresh.read().count() == 8


def test_unreadable_dead_letters_are_skipped(spark, readings):
    store = DeadLetterStore(spark, scratch_path(spark, "t-dlq-bad"))
    store.write(letters(readings), batch_id=1)
    spark.createDataFrame([("{broken",)], "value STRING").write.mode("append").text(
        f"{store.root}/messages/dl_date=2024-05-19/stage=UNKNOWN/batch_id=1")
    assert store.read().count() == 8


def test_browsing(spark, readings):
    store = DeadLetterStore(spark, scratch_path(spark, "t-dlq-browse"))
    store.write(letters(readings, F.col("status_timestamp") * 1000))
    everything = store.read()
    rows = browse.list_stage(everything.where("stage = 'UNKNOWN'")).collect()
    assert [r.kafka_offset for r in rows] == [0, 2, 4, 6]
    assert rows[0].exception == "Unknown" and rows[1].exception == "SomeVeryLongExceptio"
    assert rows[0].failed_at == "2024-05-19 06:00:00"
    assert browse.view(everything, 5).count() == 1
    assert browse.details(everything).count() == 16
    assert browse.search(everything, "verylong").count() == 6
    stats = [tuple(r) for r in browse.exception_stats(everything).collect()]
    assert stats == [("SomeVeryLongExceptionName", 6, 75.0), ("Unknown", 2, 25.0)]
    assert [tuple(r) for r in browse.stage_stats(everything).collect()] == [
        ("ARCHIVE_WRITE", 4, 50.0), ("UNKNOWN", 4, 50.0)]
    top = browse.first_per_stage(everything, shown=3).collect()
    assert len(top) == 6 and all(r.more == 1 for r in top)
    samples = browse.replay_samples(everything).collect()
    assert [(r.kafka_offset, r.messages, r.more) for r in samples] == [(0, 8, 5), (1, 8, 5), (2, 8, 5)]


def test_dead_letter_replay_uses_the_payload(readings):
    again = dead_letters_as_arrivals(letters(readings), F.current_timestamp())
    assert accepted(decode(again)).count() == 8


def test_missed_store(spark, readings):
    captured = readings.select(
        "*", (F.col("status_timestamp") * 1000 + 7).alias("arrived_ms"),
        F.lit(START * 1000).alias("down_from_ms"))
    store = MissedStore(spark, scratch_path(spark, "t-missed"))
    assert store.pending().count() == 0
    store.write(missed_rows(captured))
    raw = spark.read.parquet(f"{store.root}/missed")
    assert raw.where("payload RLIKE '\\\\s'").count() == 0
    day = store.by_date("2024-05-20").collect()
    assert [r.kafkaOffset for r in day] == [3, 4, 5, 6]
    assert day[0].downDetectionTime == "2024-05-19 00:00:00"
    since = store.since(day[2].missedAtTimestamp).collect()
    assert [r.kafkaOffset for r in since] == [5, 6, 7]
    assert {r.missed_date: r.messages for r in store.counts().collect()} == {
        "2024-05-19": 3, "2024-05-20": 4, "2024-05-21": 1}
    assert store.clear_date("2024-05-20") == 4
    assert store.clear_date("2024-05-20") == 0
    assert store.pending().count() == 4 and store.replayed().count() == 4
    assert store.by_date("2024-05-20").count() == 0 and store.all().count() == 4
    assert [r.kafkaOffset for r in store.since(day[2].missedAtTimestamp).collect()] == [7]
    assert {r.missed_date: r.messages for r in store.counts().collect()} == {
        "2024-05-19": 3, "2024-05-21": 1}
    again = missed_as_arrivals(store.pending(), F.current_timestamp())
    assert accepted(decode(again)).count() == 4


def test_undecodable_missed_payloads_are_dropped(spark, readings):
    store = MissedStore(spark, scratch_path(spark, "t-missed-bad"))
    captured = readings.select("*", F.lit(0).cast("bigint").alias("arrived_ms"),
                               F.lit(0).cast("bigint").alias("down_from_ms"))
    store.write(missed_rows(captured))
    bad = spark.createDataFrame([("%%%", "1970-01-01"), ("bm90IGpzb24=", "1970-01-01")],
                                "payload STRING, missed_date STRING")
    bad.write.mode("append").partitionBy("missed_date").parquet(f"{store.root}/missed")
    assert store.all().count() == 8


def test_invalid_envelope_shape(arrivals_of):
    rows = invalid_messages(rejected(decode(arrivals_of(["{}", None]))), F.lit(5)).collect()
    assert rows[0].value == (
        '{"original_message":"{}","validation_errors":["station_id must be positive, got: 0",'
        '"battery_status is null or empty","status_timestamp must be positive, got: 0",'
        '"weather data is null"],"rejected_at_timestamp":5,"kafka_offset":0,"kafka_partition":0}')
    assert '"original_message":null' in rows[1].value


def test_several_routes_fan_out(readings):
    rules = [("a", F.col("s_no") > 6), ("b", F.col("s_no") == 8)]
    got = [r[0] for r in readings.orderBy("s_no").select(routes(rules)).collect()]
    assert got[-3:] == [[], ["a"], ["a", "b"]]


def test_api_responses(spark):
    def body(**current):
        import json
        return json.dumps({"current": current})

    rows = [
        (1, 10, 200, body(temperature_2m=21.9, relative_humidity_2m=55, wind_speed_10m=-3.7)),
        (1, 20, 500, body(temperature_2m=1)),
        (1, 30, 200, "{}"),
        (1, 40, 200, "{broken"),
        (1, 50, 200, body(temperature_2m="12.7", relative_humidity_2m=True, wind_speed_10m={})),
        (2, 5, 200, '{"current":[]}'),
    ]
    df = spark.createDataFrame(rows, "station_id BIGINT, s BIGINT, status INT, body STRING") \
        .selectExpr("station_id", "timestamp_seconds(s) AS fetched_at", "status", "body")
    readings = normalise_responses(df)
    # The bodies were parsed once, before the numbering.
    assert "variant" not in readings._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.station_id, r.s_no, r.status_timestamp, *r.weather) for r in readings.collect())
    assert got == [
        (1, 1, 10, 55, 21, -3), (1, 2, 30, 0, 0, 0), (1, 3, 50, 1, 12, 0), (2, 1, 5, 0, 0, 0)]


def test_kafka_source_contract(spark):
    options = kafka_options("host:1", max_offsets=5, min_partitions=64)
    assert options["startingOffsets"] == "earliest"
    assert options["subscribe"] == "weather-readings"
    assert options["maxOffsetsPerTrigger"] == "5" and options["minPartitions"] == "64"
    raw = spark.sql("SELECT CAST('k' AS BINARY) key, CAST('v' AS BINARY) value, 't' topic, "
                    "3 partition, 9L offset, timestamp_seconds(1) timestamp, 0 timestampType")
    row = from_kafka_columns(raw).first()
    assert (row.key, row.value, row.kafka_partition, row.kafka_offset) == ("k", "v", 3, 9)
