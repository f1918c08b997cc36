"""Station data derived from the ``events`` table.

The derived tables are written once per application and input folder into the
shared scratch space and then read like any other source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import STAGE_ARCHIVE, STAGE_LATEST
from ..functions.timeparts import ntz_to_micros, seconds_to_millis, utc_date_text
from ..operators.decode import decode
from ..operators.dedup import keep_first
from ..operators.envelopes import dead_letters
from ..operators.latest import latest_by_station
from ..operators.outages import capture_missed, missed_rows, outage_intervals, outage_spans
from ..operators.sequences import number_rows
from ..operators.validate import accepted
from ..schemas import LATEST_ENTRY
from ..session import scratch_path
from ..sources.archive import archive_rows, write_archive
from ..sources.arrivals import file_table
from ..sources.change_log import read_change_log, write_change_log
from ..sources.dead_letters import DeadLetterStore
from ..sources.missed import MissedStore

# Fixed values of the derived data.
HEARTBEAT_TIMEOUT_MS = 1_800_000
SUBSCRIBERS = 4  # the last one never beats, and the one before stops for good
STOPPED_MS = 1_706_140_800_000  # 2024-01-25
ENROLLED_MS = 1_704_067_200_000  # 2024-01-01
AS_OF_MS = 1_706_659_200_000  # 2024-01-31
STATIONS = 10
FEED_FILES = 8  # at least; a multiple of it where a file would hold more than FEED_ROWS
FEED_ROWS = 100_000
BATCH_FILES = 20  # of a micro-batch, so that it does not grow with the feed
REPLAYED_DATE = "2024-01-12"

_written: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def derive_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals with lost rows, redeliveries, bad batteries and bad humidity."""
    event_id, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    sent = events(spark, sf_dir).select(
        "event_id",
        ntz_to_micros(F.col("ts")).alias("ts_us"),
        (F.col("user_id") % STATIONS + 1).alias("station_id"),
        F.when(event_id % 101 == 5, "dead").when(event_id % 10 < 3, "low")
        .when(event_id % 10 < 7, "medium").otherwise("high").alias("battery_status"),
        F.when(event_id % 97 == 11, 130).otherwise(k).alias("humidity"),
        (30 + event_id * 7 % 91).cast("int").alias("temperature"),
        F.least(F.floor("value"), F.lit(150)).cast("int").alias("wind_speed"),
    )
    numbered = number_rows(sent, ["station_id"], ["event_id"], "s_no")
    arrived = numbered.where(event_id % 10 != 3)
    copies = F.when(event_id % 25 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    reading = F.struct(
        "station_id", "s_no", "battery_status",
        F.floor(F.col("ts_us") / 1_000_000).alias("status_timestamp"),
        F.struct("humidity", "temperature", "wind_speed").alias("weather"),
    )
    return arrived.select("*", F.explode(copies).alias("copy")).select(
        F.col("station_id").cast("string").alias("key"),
        F.to_json(reading).alias("value"),
        (F.col("station_id") - 1).cast("int").alias("kafka_partition"),
        (event_id * 2 + F.col("copy")).alias("kafka_offset"),
        F.timestamp_micros("ts_us").alias("arrival_ts"),
    )


def arrivals_path(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "arrivals",
                 lambda path: derive_arrivals(spark, sf_dir).write.parquet(path))


def feed_share(spark: SparkSession, sf_dir: str) -> int:
    """Files that hold an eighth of the feed: more of them, and not larger ones, in a larger feed."""
    return max(1, -(-arrivals(spark, sf_dir).count() // (FEED_FILES * FEED_ROWS)))


def batch_files(spark: SparkSession, sf_dir: str, eighths: int) -> int:
    """Files of a micro-batch that takes so many eighths of the feed, or less of a large one."""
    return max(eighths, min(eighths * feed_share(spark, sf_dir), BATCH_FILES))


def write_feed(spark: SparkSession, sf_dir: str, rows: DataFrame, path: str) -> None:
    rows.repartitionByRange(FEED_FILES * feed_share(spark, sf_dir), "kafka_offset").write.parquet(path)


def feed_path(spark: SparkSession, sf_dir: str) -> str:
    """The arrivals as a feed of files, for streams of several micro-batches."""
    return once(spark, sf_dir, "feed", lambda path: write_feed(spark, sf_dir, arrivals(spark, sf_dir), path))


def late_feed_path(spark: SparkSession, sf_dir: str) -> str:
    """The same feed written newest first: every eighth is older than all before it."""
    def write(path: str) -> None:
        rows = arrivals(spark, sf_dir)
        low, high = rows.agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
        step, share = (high - low) // FEED_FILES + 1, feed_share(spark, sf_dir)
        for n in reversed(range(FEED_FILES)):
            rows.where(F.col("kafka_offset").between(low + step * n, low + step * (n + 1) - 1)) \
                .repartition(share).write.mode("append").parquet(path)
    return once(spark, sf_dir, "late-feed", write)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_table(spark, arrivals_path(spark, sf_dir))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(arrivals(spark, sf_dir))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(decoded(spark, sf_dir))


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(valid(spark, sf_dir))


def odd_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival bent in one of twenty ways that strain JSON binding.

    The way is ``kafka_offset div 20 mod 20``.
    """
    value = F.col("value")

    def swap(pattern: str, replacement: str) -> Column:
        return F.regexp_replace(value, pattern, replacement)

    ways = [
        F.lit("not json"),
        F.substring(value, 1, 40),
        F.concat(F.lit("["), value, F.lit("]")),
        F.lit(""),
        F.lit(None).cast("string"),
        F.translate(value, '"', "'"),
        swap('"humidity":[0-9]+', '"humidity":99999999999'),
        swap('"station_id":[0-9]+', '"station_id":true'),
        swap('"weather":.*$', '"weather":"x"}'),
        swap('"battery_status":"[a-z]+"', '"battery_status":{"a":1}'),
        swap('"station_id":([0-9]+)', '"station_id":"$1"'),
        swap('"humidity":([0-9]+)', '"humidity":$1.9'),
        swap('^\\{', '{"extra":[1,{"a":2}],'),
        F.concat(value, F.lit(" trailing")),
        swap('"weather":.*$', '"weather":null}'),
        swap('"weather":.*$', '"weather":{}}'),
        swap('"battery_status":"[a-z]+",', ""),
        F.lit(" null "),
        F.lit("{}"),
        swap('"battery_status":"[a-z]+"', '"battery_status":"LOW"'),
    ]
    way = F.floor(F.col("kafka_offset") / 20) % len(ways)
    bent = F.lit(None).cast("string")
    for number, text in reversed(list(enumerate(ways))):
        bent = F.when(way == number, text).otherwise(bent)
    return arrivals(spark, sf_dir).withColumn("value", bent)


def extreme_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals, some stamped with times that have no calendar date or a far one.

    ``kafka_offset div 20 mod 5`` tells which: 0 the largest long, 1 the last second with a
    date, 2 the first without, 3 the year 10000, 4 unchanged.
    """
    way = F.floor(F.col("kafka_offset") / 20) % 5
    stamp = F.when(way == 0, F.lit("9223372036854775807")).when(way == 1, F.lit("185542587187199")) \
        .when(way == 2, F.lit("185542587187200")).when(way == 3, F.lit("253402300800"))
    bent = F.regexp_replace(F.col("value"), F.lit('"status_timestamp":[0-9]+'),
                            F.concat(F.lit('"status_timestamp":'), stamp))
    return arrivals(spark, sf_dir).withColumn("value", F.coalesce(bent, "value"))


def misnamed_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station 10 is configured to call itself station 9."""
    return arrivals(spark, sf_dir).withColumn(
        "value", F.regexp_replace("value", '"station_id":10,', '"station_id":9,'))


def misnamed_feed_path(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "misnamed-feed",
                lambda path: write_feed(spark, sf_dir, misnamed_arrivals(spark, sf_dir), path))


def restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded readings where even stations restart their numbering every 97."""
    looped = F.when(F.col("station_id") % 2 == 0, (F.col("s_no") - 1) % 97 + 1) \
        .otherwise(F.col("s_no"))
    return decoded(spark, sf_dir).withColumn("s_no", looped)


def archive_path(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, sf_dir, "archive", lambda path: write_archive(
        archive_rows(unique(spark, sf_dir)), path))


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid arrivals as log entries, one segment per UTC date."""
    def write(path: str) -> None:
        write_change_log(
            valid(spark, sf_dir).select(
                utc_date_text(seconds_to_millis(F.col("status_timestamp"))).alias("segment"),
                F.col("kafka_offset").alias("pos"),
                F.col("station_id").cast("string").alias("key"),
                "value",
            ), path)
    return read_change_log(spark, once(spark, sf_dir, "change-log", write))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored latest values, for queries that read rather than compute them."""
    path = once(spark, sf_dir, "latest",
                lambda p: latest_by_station(valid(spark, sf_dir)).write.parquet(p))
    return spark.read.schema(LATEST_ENTRY).parquet(path)


def expected_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest values with key 4 altered, key 7 removed and key 99 added."""
    rows = latest(spark, sf_dir).select("key", "value")
    altered = rows.where("key <> '7'").withColumn(
        "value", F.when(F.col("key") == "4", F.lit("{}")).otherwise(F.col("value")))
    return altered.unionByName(rows.where("key = '1'").withColumn("key", F.lit("99")))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lookup per event over stations 1 to 12; 11 and 12 do not exist."""
    return events(spark, sf_dir).select(
        (F.col("user_id") % 12 + 1).cast("string").alias("key"))


def dead_letter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    failing = unique(spark, sf_dir).where("s_no % 20 = 0")
    s_no = F.col("s_no")
    stage = F.when(s_no % 40 == 0, STAGE_ARCHIVE).otherwise(STAGE_LATEST)
    kind = F.when(s_no % 3 == 0, "IOException").when(s_no % 3 == 1, "TimeoutException")
    reasons = F.when(
        s_no % 3 == 1, F.array(F.concat(stage, F.lit(" failed")), F.lit("gave up waiting"))
    ).otherwise(F.array(F.concat(stage, F.lit(" failed"))))
    rows = dead_letters(failing, stage, reasons, kind, F.lower(kind),
                        seconds_to_millis(F.col("status_timestamp")))
    return rows.withColumn(
        "station_id", F.when(F.col("sequence_number") % 100 != 0, F.col("station_id")))


def dead_letter_store(spark: SparkSession, sf_dir: str) -> DeadLetterStore:
    return DeadLetterStore(spark, once(
        spark, sf_dir, "dead-letters",
        lambda path: DeadLetterStore(spark, path).write(dead_letter_rows(spark, sf_dir))))


def roster(spark: SparkSession) -> DataFrame:
    """Everyone who should beat, and since when."""
    return spark.range(SUBSCRIBERS).select(
        F.col("id").cast("string").alias("subscriber"), F.lit(ENROLLED_MS).cast("bigint").alias("enrolled_ms"))


def heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One beat per event; each subscriber is silent for one hour of every day."""
    member = F.col("user_id") % SUBSCRIBERS
    beats = events(spark, sf_dir).select(
        member.alias("_member"), member.cast("string").alias("subscriber"),
        F.floor(ntz_to_micros(F.col("ts")) / 1000).alias("beat_ms"))
    hour = F.floor(F.col("beat_ms") / 3_600_000)
    stopped = (F.col("_member") == SUBSCRIBERS - 2) & (F.col("beat_ms") >= STOPPED_MS)
    return beats.where((F.col("_member") < SUBSCRIBERS - 1) & ~stopped
                       & ((hour + F.col("_member") * 5) % 24 != 0)).drop("_member")


def outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outages as a written table, so joins know its size; those still open have no end."""
    path = once(spark, sf_dir, "outages", lambda p: outage_intervals(
        heartbeats(spark, sf_dir), HEARTBEAT_TIMEOUT_MS, as_of_ms=AS_OF_MS, roster=roster(spark),
        open_ended=True).write.parquet(p))
    return spark.read.schema(
        "subscriber STRING, down_from_ms BIGINT, down_to_ms BIGINT").parquet(path)


def subscriber_of() -> Column:
    """The subscriber that owns a source partition."""
    return (F.col("kafka_partition") % SUBSCRIBERS).cast("string")


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = once(spark, sf_dir, "outage-spans",
                lambda p: outage_spans(outages(spark, sf_dir), watermark_ms=AS_OF_MS).write.parquet(p))
    spans = spark.read.schema(
        "subscriber STRING, down_from_ms BIGINT, down_to_ms BIGINT, _bucket BIGINT").parquet(path)
    return capture_missed(arrivals(spark, sf_dir), spans, subscriber_of())


def missed_store(spark: SparkSession, sf_dir: str) -> MissedStore:
    return MissedStore(spark, once(
        spark, sf_dir, "missed",
        lambda path: MissedStore(spark, path).write(missed_rows(captured(spark, sf_dir)))))


def partly_replayed(spark: SparkSession, sf_dir: str) -> MissedStore:
    """The missed messages after those of one date were replayed."""
    def write(path: str) -> None:
        store = MissedStore(spark, path)
        store.write(missed_rows(captured(spark, sf_dir)))
        store.clear_date(REPLAYED_DATE)
    return MissedStore(spark, once(spark, sf_dir, "partly-replayed", write))


def op_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    event_id = F.col("event_id")
    return events(spark, sf_dir).select(
        F.when(event_id % 2 == 0, "read").otherwise("write").alias("op"),
        F.col("user_id").cast("string").alias("key"),
        (event_id % 1000 + 1).alias("ns"),
        (event_id % 51 != 0).alias("hit"))


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather API responses: decimals, a missing block, broken JSON, errors."""
    event_id = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    body = (
        F.when(event_id % 37 == 0, F.lit('{"latitude":30.06}'))
        .when(event_id % 41 == 0, F.lit('{"current":'))
        .otherwise(F.concat(
            F.lit('{"latitude":30.06,"current":{"temperature_2m":'),
            (30 + event_id * 7 % 91).cast("string"), F.lit('.7,"relative_humidity_2m":'), k,
            F.when(event_id % 5 == 0, F.lit(""))
            .otherwise(F.concat(F.lit(',"wind_speed_10m":'), F.floor("value").cast("string"))),
            F.lit("}}")))
    )
    return events(spark, sf_dir).select(
        (F.col("user_id") % STATIONS + 1).alias("station_id"),
        F.timestamp_micros(ntz_to_micros(F.col("ts"))).alias("fetched_at"),
        F.when(event_id % 50 == 0, 500).otherwise(200).alias("status"),
        body.alias("body"))


def sequence_of_writes(spark: SparkSession, sf_dir: str, parts: int) -> list[DataFrame]:
    """Valid readings cut by arrival into consecutive batches."""
    rows = valid(spark, sf_dir)
    low, high = arrivals(spark, sf_dir).agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
    step = (high - low) // parts + 1
    return [rows.where((F.col("kafka_offset") >= low + step * n)
                       & (F.col("kafka_offset") < low + step * (n + 1))) for n in range(parts)]

