"""Explicit schemas. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_TEXTS, _TIME = T.ArrayType(T.StringType()), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


ARRIVAL = _struct(
    key=_TEXT, value=_TEXT, kafka_partition=_INT, kafka_offset=_LONG, arrival_ts=_TIME)

def _reading(number: T.DataType, small: T.DataType) -> T.StructType:
    return _struct(
        station_id=number, s_no=number, battery_status=_TEXT, status_timestamp=number,
        weather=_struct(humidity=small, temperature=small, wind_speed=small),
        _unparsed=_TEXT)


# A well-typed message binds to the first one. Whatever does not is read again with
# string leaves, so that type coercion is ours to define (see operators.decode).
READING = _reading(_LONG, _INT)
READING_AS_TEXT = _reading(_TEXT, _TEXT)

ARCHIVE_COLUMNS = [
    "station_id", "s_no", "battery_status", "status_timestamp", "humidity",
    "temperature", "wind_speed", "year", "month", "day",
]
ARCHIVE_PARTITIONS = ["year", "month", "day", "station_id"]
UNDATED_YEAR = 0  # the partition of rows whose time has no calendar date
ARCHIVE = _struct(
    s_no=_LONG, battery_status=_TEXT, status_timestamp=_LONG, humidity=_INT,
    temperature=_INT, wind_speed=_INT, year=_INT, month=_INT, day=_INT, station_id=_LONG)

DEAD_LETTER = _struct(
    original_message=_TEXT, failure_reasons=_TEXTS, failed_at_timestamp_ms=_LONG,
    kafka_offset=_LONG, kafka_partition=_INT, processing_stage=_TEXT, exception_type=_TEXT,
    exception_message=_TEXT, station_id=_LONG, sequence_number=_LONG,
    dl_date=_TEXT, stage=_TEXT)
DEAD_LETTER_ID = _struct(
    failed_at_timestamp_ms=_LONG, kafka_partition=_INT, kafka_offset=_LONG,
    dl_date=_TEXT, stage=_TEXT)

MISSED_BODY = _struct(
    originalMessage=_TEXT, kafkaOffset=_LONG, kafkaPartition=_INT, messageTimestamp=_LONG,
    missedAtTimestamp=_LONG, downDetectionTime=_TEXT)
MISSED_TABLE = _struct(payload=_TEXT, kafkaPartition=_INT, kafkaOffset=_LONG, missed_date=_TEXT)
REPLAYED_ID = _struct(kafkaPartition=_INT, kafkaOffset=_LONG, missed_date=_TEXT)

CHANGE_LOG = _struct(segment=_TEXT, pos=_LONG, key=_TEXT, value=_TEXT)

COMMIT = _struct(number=_LONG, committed_at_ms=_LONG)
MERGED_DATE = _struct(date_number=_LONG, version=_LONG, batch=_LONG, replay=_LONG)
LEDGER = _struct(
    failed_at_timestamp_ms=_LONG, kafka_partition=_INT, kafka_offset=_LONG, dl_date=_TEXT,
    stage=_TEXT, attempt=_INT, sink=_TEXT, outcome=_TEXT, replay_id=_LONG)
ATTEMPT = _struct(
    failed_at_timestamp_ms=_LONG, kafka_partition=_INT, kafka_offset=_LONG, replay_id=_LONG,
    dl_date=_TEXT, stage=_TEXT)

LATEST_ENTRY = _struct(key=_TEXT, value=_TEXT, kafka_partition=_INT, kafka_offset=_LONG)
LATEST_DELTA = with_field(with_field(LATEST_ENTRY, "kind", _TEXT), "batch_id", _LONG)
LATEST_VERSION = _struct(version=_LONG)
