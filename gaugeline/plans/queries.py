"""The registered queries: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import csv_quoted, display_key, one_decimal, zero_padded
from ..functions.timeparts import readable_stamp, seconds_to_millis, utc_timestamp_text
from ..operators import browse, latest as latest_ops, metrics, outages as outage_ops, sequences
from ..operators.alerts import alert_messages, alert_rows
from ..operators.decode import decode, flatten, parse_failures as failed_to_parse, parsed_only
from ..operators.dedup import channel_counts, eviction_set, keep_first, older_than
from ..operators.envelopes import invalid_messages
from ..operators.forecast import normalise_responses
from ..operators.replay import dead_letters_as_arrivals, missed_as_arrivals, with_replayed
from ..operators.routing import routed_messages as route
from ..operators.validate import accepted, error_rows, is_valid, rejected
from ..schemas import ARCHIVE_COLUMNS
from ..session import scratch_path
from ..sources.archive import archive_rows, compact_archive, read_archive, read_undated, write_archive
from ..sources.dead_letters import DeadLetterStore
from ..sources.latest_store import LatestStore, export_csv, read_csv_export
from ..sources.missed import MissedStore
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DATE = "2024-01-10"
REPLAY_AT_US = 1_800_000_000_000_000
AS_OF_MS = fx.AS_OF_MS
SINCE_MS = 1_705_276_800_000


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- decode and validate ---------------------------------------------------

@query
def decoded_readings(spark, sf_dir):
    return flatten(parsed_only(fx.decoded(spark, sf_dir))).select(
        *ARCHIVE_COLUMNS, "kafka_partition", "kafka_offset")


@query
def parse_failures(spark, sf_dir):
    return failed_to_parse(decode(fx.odd_arrivals(spark, sf_dir))).select(
        "kafka_partition", "kafka_offset", F.explode("validation_errors").alias("error"))


@query
def decode_edges(spark, sf_dir):
    bound = parsed_only(decode(fx.odd_arrivals(spark, sf_dir)))
    return bound.select(
        "kafka_offset", "is_null_reading", "station_id", "s_no", "battery_status",
        "status_timestamp", F.col("weather").isNotNull().alias("has_weather"),
        "weather.humidity", "weather.temperature", "weather.wind_speed",
        is_valid().alias("valid"))


@query
def edge_errors(spark, sf_dir):
    return error_rows(rejected(decode(fx.odd_arrivals(spark, sf_dir))))


@query
def validation_errors(spark, sf_dir):
    return error_rows(rejected(fx.decoded(spark, sf_dir)))


@query
def validity_split(spark, sf_dir):
    return channel_counts(fx.decoded(spark, sf_dir))


@query
def invalid_envelopes(spark, sf_dir):
    return invalid_messages(rejected(fx.decoded(spark, sf_dir)),
                            F.lit(AS_OF_MS).cast("bigint"))


# --- de-duplicate, alert, route ---------------------------------------------

@query
def dedup_first(spark, sf_dir):
    return flatten(fx.unique(spark, sf_dir)).select(
        "station_id", "s_no", "kafka_partition", "kafka_offset", "battery_status",
        "status_timestamp", "humidity", "temperature", "wind_speed")


@query
def rain_alerts_stream(spark, sf_dir):
    return alert_messages(fx.decoded(spark, sf_dir))


@query
def rain_alerts_valid(spark, sf_dir):
    return alert_rows(fx.unique(spark, sf_dir))


@query
def routed_messages(spark, sf_dir):
    return route(fx.unique(spark, sf_dir))


def _tracked(spark, sf_dir):
    return fx.unique(spark, sf_dir).select(
        "station_id", "s_no", F.unix_millis("arrival_ts").alias("recorded_at"))


@query
def evict_oldest(spark, sf_dir):
    return eviction_set(_tracked(spark, sf_dir), capacity=500)


@query
def evict_older_than(spark, sf_dir):
    return older_than(_tracked(spark, sf_dir), SINCE_MS)


# --- archive ------------------------------------------------------------------

@query
def archive_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "archive-roundtrip")
    write_archive(archive_rows(fx.unique(spark, sf_dir)), path)
    return read_archive(spark, path).select(*ARCHIVE_COLUMNS)


@query
def archive_pruned(spark, sf_dir):
    rows = read_archive(spark, fx.archive_path(spark, sf_dir))
    return rows.where("year = 2024 AND month = 1 AND day = 10 AND station_id = 3") \
        .select(*ARCHIVE_COLUMNS)


@query
def archive_humid(spark, sf_dir):
    rows = read_archive(spark, fx.archive_path(spark, sf_dir))
    return rows.where("humidity > 70").groupBy("station_id", "month", "day").agg(
        F.count("*").alias("rainy"), F.max("wind_speed").alias("max_wind"))


@query
def archive_compacted(spark, sf_dir):
    """Two micro-batches, one of them written twice, folded into a fresh archive."""
    small, merged = scratch_path(spark, "archive-batches"), scratch_path(spark, "archive-merged")
    rows = archive_rows(fx.unique(spark, sf_dir))
    for batch_id, part in enumerate([rows.where("day <= 15"), rows.where("day > 15")]):
        write_archive(part, small, batch_id)
    write_archive(rows.where("day > 15"), small, 1)
    compact_archive(spark, small, merged)
    return read_archive(spark, merged).select(*ARCHIVE_COLUMNS)


def _extreme_archive(spark, sf_dir) -> str:
    return fx.once(spark, sf_dir, "archive-extreme", lambda path: write_archive(
        archive_rows(keep_first(accepted(decode(fx.extreme_arrivals(spark, sf_dir))))), path))


@query
def archive_extreme(spark, sf_dir):
    """Valid messages with extreme times: the archive stays readable."""
    return read_archive(spark, _extreme_archive(spark, sf_dir)).select(*ARCHIVE_COLUMNS)


@query
def archive_undated(spark, sf_dir):
    """Those without a calendar date, in their side partition."""
    rows = read_undated(spark, _extreme_archive(spark, sf_dir))
    return rows.select("station_id", "s_no", "status_timestamp", "humidity")


@query
def station_counts(spark, sf_dir):
    return metrics.station_counts(fx.unique(spark, sf_dir))


@query
def storage_summary(spark, sf_dir):
    """Files of an archive written as one micro-batch: one for each directory."""
    path = fx.once(spark, sf_dir, "archive-batch", lambda p: write_archive(
        archive_rows(fx.unique(spark, sf_dir)), p, batch_id=0))
    return metrics.storage_summary(spark, path).select(
        "files", (F.col("bytes") > 0).alias("has_bytes"), (F.col("smallest") > 0).alias("none_empty"))


# --- latest values ------------------------------------------------------------

@query
def latest_by_station(spark, sf_dir):
    return latest_ops.latest_by_station(fx.valid(spark, sf_dir)).select("key", "value")


@query
def latest_upsert(spark, sf_dir):
    """Four consecutive batches, a compaction between them, and one batch replayed."""
    store = LatestStore(spark, scratch_path(spark, "latest"))
    batches = fx.sequence_of_writes(spark, sf_dir, 4)
    for batch_id, batch in enumerate(batches):
        store.write_batch(batch, batch_id)
        if batch_id == 1:
            store.compact()
    store.write_batch(batches[0], 0)
    return store.read().select("key", "value")


@query
def compact_log(spark, sf_dir):
    return latest_ops.compact_log(fx.change_log(spark, sf_dir))


@query
def raw_vs_unique(spark, sf_dir):
    return metrics.raw_vs_unique(fx.change_log(spark, sf_dir))


@query
def point_lookup(spark, sf_dir):
    return latest_ops.point_lookup(fx.latest(spark, sf_dir).select("key", "value"), "3")


@query
def lookup_hits(spark, sf_dir):
    return latest_ops.lookup_counts(fx.probes(spark, sf_dir), fx.latest(spark, sf_dir))


@query
def lookup_rows(spark, sf_dir):
    """Every single probe with its value; the stored side is a written table."""
    found = latest_ops.batch_lookup(fx.probes(spark, sf_dir), fx.latest(spark, sf_dir))
    return found.select("key", F.length("value").alias("value_chars"))


@query
def lookup_missing(spark, sf_dir):
    return latest_ops.missing_keys(fx.probes(spark, sf_dir), fx.latest(spark, sf_dir))


@query
def reconcile(spark, sf_dir):
    return latest_ops.reconcile(fx.expected_latest(spark, sf_dir), fx.latest(spark, sf_dir))


@query
def reconcile_counts(spark, sf_dir):
    return reconcile(spark, sf_dir).groupBy("status").agg(F.count("*").alias("keys"))


@query
def csv_export_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv-export")
    export_csv(fx.latest(spark, sf_dir), path)
    return read_csv_export(spark, path)


@query
def csv_lines(spark, sf_dir):
    """The exported lines as text."""
    path = scratch_path(spark, "csv-lines")
    export_csv(fx.latest(spark, sf_dir), path)
    return spark.read.text(path).where("value <> 'key,value' AND value <> '\"key\",\"value\"'") \
        .select(F.col("value").alias("line"))


@query
def csv_fields(spark, sf_dir):
    """Quoted fields by expression, one per valid arrival."""
    return fx.valid(spark, sf_dir).select(
        "kafka_offset", csv_quoted(F.col("value")).alias("field"))


# --- dead letters -------------------------------------------------------------

@query
def dlq_list(spark, sf_dir):
    return browse.list_stage(fx.dead_letter_store(spark, sf_dir).read(DATE, "ARCHIVE_WRITE"))


@query
def dlq_by_date(spark, sf_dir):
    return fx.dead_letter_store(spark, sf_dir).read(DATE).select(
        "stage", "kafka_offset", "original_message")


@query
def dlq_partitions(spark, sf_dir):
    return browse.dates_and_stages(fx.dead_letter_store(spark, sf_dir).read())


@query
def dlq_view(spark, sf_dir):
    store = fx.dead_letter_store(spark, sf_dir)
    one = store.read(DATE, "LATEST_WRITE").agg(F.min("kafka_offset")).first()[0]
    return browse.view(store.read(DATE, "LATEST_WRITE"), one).select(
        "dl_date", "stage", "kafka_offset", "original_message")


@query
def dlq_details(spark, sf_dir):
    return browse.details(fx.dead_letter_store(spark, sf_dir).read())


@query
def dlq_station(spark, sf_dir):
    return browse.station_failures(fx.dead_letter_store(spark, sf_dir).by_station(5))


@query
def dlq_search(spark, sf_dir):
    return browse.search(fx.dead_letter_store(spark, sf_dir).read(), "timeout")


@query
def dlq_stage_stats(spark, sf_dir):
    return browse.stage_stats(fx.dead_letter_store(spark, sf_dir).read())


@query
def dlq_exception_stats(spark, sf_dir):
    return browse.exception_stats(fx.dead_letter_store(spark, sf_dir).read())


@query
def dlq_stage_counts(spark, sf_dir):
    return browse.stage_counts(fx.dead_letter_store(spark, sf_dir).read(DATE))


@query
def dlq_top5(spark, sf_dir):
    return browse.first_per_stage(fx.dead_letter_store(spark, sf_dir).read())


@query
def dlq_replay_samples(spark, sf_dir):
    return browse.replay_samples(fx.dead_letter_store(spark, sf_dir).read(stage="LATEST_WRITE"))


@query
def dlq_export(spark, sf_dir):
    path = scratch_path(spark, "dlq-export")
    fx.dead_letter_store(spark, sf_dir).export(path, DATE)
    lines = spark.read.text(path)
    return lines.select(
        F.get_json_object("value", "$.kafka_offset").cast("bigint").alias("kafka_offset"),
        F.get_json_object("value", "$.original_message").alias("original_message"))


@query
def dlq_delete(spark, sf_dir):
    """Delete the dead letters of one exception, then read what is left."""
    store = DeadLetterStore(spark, scratch_path(spark, "dlq-delete"))
    store.write(fx.dead_letter_rows(spark, sf_dir))
    store.delete(store.read().where("exception_type = 'IOException'"))
    return store.vacuum(scratch_path(spark, "dlq-vacuum")).read().select(
        "dl_date", "stage", "kafka_offset")


@query
def dlq_replay(spark, sf_dir):
    """Dead letters put back in front of the live arrivals that lack them."""
    dead = fx.dead_letter_store(spark, sf_dir).read()
    ids = ["kafka_partition", "kafka_offset"]
    live = fx.arrivals(spark, sf_dir).join(dead.select(*ids), ids, "left_anti")
    again = dead_letters_as_arrivals(dead, F.timestamp_micros(F.lit(REPLAY_AT_US)))
    restored = keep_first(accepted(decode(with_replayed(again, live))))
    return restored.groupBy("station_id").agg(
        F.count("*").alias("readings"), F.sum("s_no").alias("sum_s_no"))


# --- outages and missed messages ------------------------------------------------

@query
def outage_intervals(spark, sf_dir):
    """Closed outages, and those still open: of members that stopped or never beat."""
    return outage_ops.outage_intervals(fx.heartbeats(spark, sf_dir), fx.HEARTBEAT_TIMEOUT_MS,
                                       as_of_ms=AS_OF_MS, roster=fx.roster(spark), open_ended=True)


@query
def silent_station_intervals(spark, sf_dir):
    beats = fx.valid(spark, sf_dir).select(
        "station_id", F.unix_millis("arrival_ts").alias("beat_ms"))
    return outage_ops.outage_intervals(
        beats, fx.HEARTBEAT_TIMEOUT_MS, who="station_id", as_of_ms=AS_OF_MS)


@query
def missed_capture(spark, sf_dir):
    return fx.captured(spark, sf_dir).select(
        "subscriber", "kafka_partition", "kafka_offset", "arrived_ms", "value")


@query
def missed_envelopes(spark, sf_dir):
    return fx.missed_store(spark, sf_dir).all()


@query
def missed_by_date(spark, sf_dir):
    return fx.missed_store(spark, sf_dir).by_date(DATE)


@query
def missed_since(spark, sf_dir):
    return fx.missed_store(spark, sf_dir).since(SINCE_MS).select(
        "kafkaPartition", "kafkaOffset", "missedAtTimestamp")


@query
def missed_counts(spark, sf_dir):
    return fx.missed_store(spark, sf_dir).counts()


@query
def replay_union(spark, sf_dir):
    """Missed messages first, then everything live: the same result as no outage."""
    again = missed_as_arrivals(
        fx.missed_store(spark, sf_dir).pending(), F.timestamp_micros(F.lit(REPLAY_AT_US)))
    both = with_replayed(again, fx.arrivals(spark, sf_dir))
    return keep_first(accepted(decode(both))).select("station_id", "s_no", "value")


@query
def clear_replayed(spark, sf_dir):
    """What is still pending after one date was replayed and cleared."""
    store = MissedStore(spark, scratch_path(spark, "clear-replayed"))
    store.write(outage_ops.missed_rows(fx.captured(spark, sf_dir)))
    cleared = store.clear_date(DATE)
    return store.pending().groupBy("missed_date").agg(
        F.count("*").alias("pending"), F.lit(cleared).cast("bigint").alias("cleared_on_date"))


@query
def missed_statistics(spark, sf_dir):
    return fx.partly_replayed(spark, sf_dir).statistics()


@query
def subscriber_status(spark, sf_dir):
    store = fx.partly_replayed(spark, sf_dir)
    owner = (F.col("kafkaPartition") % fx.SUBSCRIBERS).cast("string").alias("subscriber")
    as_of = F.lit(AS_OF_MS).cast("bigint")
    health = outage_ops.health(
        fx.heartbeats(spark, sf_dir), as_of, fx.HEARTBEAT_TIMEOUT_MS, fx.roster(spark))
    return metrics.subscriber_status(
        health, fx.outages(spark, sf_dir), store.pending_ids().select(owner),
        store.replayed().select(owner), as_of)


# --- reports --------------------------------------------------------------------

@query
def op_latency(spark, sf_dir):
    return metrics.op_latency(fx.op_timings(spark, sf_dir))


@query
def hit_rate(spark, sf_dir):
    return metrics.hit_rate(fx.op_timings(spark, sf_dir))


@query
def openmeteo_normalised(spark, sf_dir):
    return normalise_responses(fx.api_responses(spark, sf_dir)).select(
        "station_id", "s_no", "battery_status", "status_timestamp", "weather.*")


@query
def lost_readings(spark, sf_dir):
    return sequences.lost_readings(sequences.transmissions(fx.restarted(spark, sf_dir)))


@query
def gap_list(spark, sf_dir):
    return sequences.gap_list(sequences.transmissions(fx.restarted(spark, sf_dir)))


@query
def key_conflicts(spark, sf_dir):
    return sequences.key_conflicts(
        accepted(decode(fx.misnamed_arrivals(spark, sf_dir))))


@query
def battery_share(spark, sf_dir):
    return metrics.battery_share(fx.unique(spark, sf_dir))


@query
def display_fields(spark, sf_dir):
    """Display helpers over every valid arrival."""
    rows = flatten(fx.valid(spark, sf_dir))
    compact = F.concat(
        F.col("year").cast("string"), zero_padded(F.col("month"), 2),
        zero_padded(F.col("day"), 2), F.lit("101112"),
        F.when(F.col("s_no") % 2 == 0, F.lit("_007")).otherwise(F.lit("")))
    return rows.select(
        "kafka_offset",
        display_key(F.col("station_id"), F.col("s_no")).alias("display_key"),
        utc_timestamp_text(seconds_to_millis(F.col("status_timestamp"))).alias("sent_at"),
        readable_stamp(F.when(F.col("s_no") % 3 == 0, F.lit("bad_name")).otherwise(compact))
        .alias("segment_time"),
        one_decimal(F.col("humidity") / 8).alias("eighth"))
