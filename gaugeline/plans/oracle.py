"""Oracle SQL (DuckDB) for every registered query that SQL can express."""

from __future__ import annotations

from .oracle_base import with_dead_letters, with_outages, with_readings

_PARSE = "'JSON parsing failed: payload does not bind to a reading'"
_BATTERY_ERR = ("CASE WHEN battery_status = 'dead' THEN "
                "'battery_status must be one of [low, medium, high], got: ''dead''' END")
_HUMID_ERR = ("CASE WHEN humidity > 100 THEN "
              "'humidity must be between 0 and 100, got: ' || humidity END")
_DATE = "2024-01-10"
_AS_OF = "1706659200000"
_SINCE = "1705276800000"
_SENT = "make_timestamp(status_timestamp * 1000000)"
_YMD = (f"CAST(year({_SENT}) AS INT) AS year, CAST(month({_SENT}) AS INT) AS month, "
        f"CAST(day({_SENT}) AS INT) AS day")
_ARCHIVE = ("station_id, s_no, battery_status, status_timestamp, humidity, temperature, "
            f"wind_speed, {_YMD}")
_ALERT_JSON = """'{"station_id":' || station_id || ',"alert_type":"RAIN_DETECTED","humidity":'
    || humidity || ',"temperature":' || temperature || ',"wind_speed":' || wind_speed
    || ',"status_timestamp":' || status_timestamp || '}'"""
_ROUTED = """SELECT 'rain-alerts' AS topic, 'station-' || station_id AS key, value
    FROM u WHERE humidity > 70"""
_ERRORS = f"[x FOR x IN [{_BATTERY_ERR}, {_HUMID_ERR}] IF x IS NOT NULL]"
_EXPECTED = """
    wanted AS (SELECT key, CASE key WHEN '4' THEN '{}' ELSE value END AS value
        FROM latest WHERE key <> '7'
      UNION ALL SELECT '99', value FROM latest WHERE key = '1'),
    matched AS (SELECT coalesce(w.key, l.key) AS key,
        CASE WHEN l.key IS NULL THEN 'missing' WHEN w.key IS NULL THEN 'extra'
             WHEN w.value = l.value THEN 'ok' ELSE 'mismatch' END AS status
      FROM wanted w FULL OUTER JOIN latest l ON w.key = l.key)"""
_RESTARTED = """
    w AS (SELECT *, CASE WHEN station_id % 2 = 0 THEN (s_no - 1) % 97 + 1 ELSE s_no END AS n FROM r),
    t AS (SELECT station_id, n, status_timestamp, min(kafka_offset) AS kafka_offset
        FROM w GROUP BY ALL),
    p AS (SELECT *, lag(n) OVER (PARTITION BY station_id ORDER BY kafka_offset) AS before FROM t)"""
_WAY = "(event_id // 10) % 20"

ORACLE: dict[str, str] = {
    "decoded_readings": with_readings(
        f"SELECT {_ARCHIVE}, kafka_partition, kafka_offset FROM r"),
    "parse_failures": with_readings(
        f"SELECT kafka_partition, kafka_offset, {_PARSE} AS error FROM r WHERE {_WAY} < 10"),
    "decode_edges": with_readings(f"""
        , x AS (SELECT *, {_WAY} AS way FROM r WHERE {_WAY} >= 10)
        SELECT kafka_offset, way = 17 AS is_null_reading,
          CASE WHEN way IN (17, 18) THEN 0 ELSE station_id END AS station_id,
          CASE WHEN way IN (17, 18) THEN 0 ELSE s_no END AS s_no,
          CASE WHEN way IN (16, 17, 18) THEN NULL WHEN way = 19 THEN 'LOW'
               ELSE battery_status END AS battery_status,
          CASE WHEN way IN (17, 18) THEN 0 ELSE status_timestamp END AS status_timestamp,
          way NOT IN (14, 17, 18) AS has_weather,
          CASE WHEN way IN (14, 17, 18) THEN NULL WHEN way = 15 THEN 0 ELSE humidity END AS humidity,
          CASE WHEN way IN (14, 17, 18) THEN NULL WHEN way = 15 THEN 0 ELSE temperature END AS temperature,
          CASE WHEN way IN (14, 17, 18) THEN NULL WHEN way = 15 THEN 0 ELSE wind_speed END AS wind_speed,
          CASE WHEN way IN (14, 16, 17, 18) THEN false
               WHEN way = 15 THEN battery_status <> 'dead'
               WHEN way = 19 THEN humidity <= 100
               ELSE humidity <= 100 AND battery_status <> 'dead' END AS valid
        FROM x"""),
    "edge_errors": with_readings(f"""
        , x AS (SELECT kafka_partition, kafka_offset, {_WAY} AS way,
            {_BATTERY_ERR} AS bad_battery, {_HUMID_ERR} AS bad_humidity FROM r),
        y AS (SELECT kafka_partition, kafka_offset,
            CASE WHEN way < 10 THEN [{_PARSE}]
                 WHEN way = 17 THEN ['WeatherReading is null']
                 WHEN way = 18 THEN ['station_id must be positive, got: 0',
                     'battery_status is null or empty',
                     'status_timestamp must be positive, got: 0', 'weather data is null']
                 ELSE [z FOR z IN [
                     CASE WHEN way = 16 THEN 'battery_status is null or empty'
                          WHEN way = 19 THEN NULL ELSE bad_battery END,
                     CASE WHEN way = 14 THEN 'weather data is null'
                          WHEN way = 15 THEN NULL ELSE bad_humidity END] IF z IS NOT NULL]
                 END AS errs FROM x)
        SELECT kafka_partition, kafka_offset,
          CAST(unnest(range(1, len(errs) + 1)) AS INT) AS error_no, unnest(errs) AS error FROM y"""),
    "validation_errors": with_readings(f"""
        , y AS (SELECT kafka_partition, kafka_offset, {_ERRORS} AS errs FROM r)
        SELECT kafka_partition, kafka_offset,
          CAST(unnest(range(1, len(errs) + 1)) AS INT) AS error_no, unnest(errs) AS error FROM y"""),
    "validity_split": with_readings("""
        SELECT 'accepted' AS channel, (SELECT count(*) FROM u) AS messages
        UNION ALL SELECT 'duplicate', (SELECT count(*) FROM v) - (SELECT count(*) FROM u)
        UNION ALL SELECT 'invalid', (SELECT count(*) FROM r) - (SELECT count(*) FROM v)"""),
    "invalid_envelopes": with_readings(f"""
        , y AS (SELECT *, {_ERRORS} AS errs FROM r WHERE humidity > 100 OR battery_status = 'dead')
        SELECT '{{"original_message":"' || replace(value, '"', '\\"') || '","validation_errors":["'
          || array_to_string(errs, '","') || '"],"rejected_at_timestamp":{_AS_OF},"kafka_offset":'
          || kafka_offset || ',"kafka_partition":' || kafka_partition || '}}' AS value FROM y"""),
    "dedup_first": with_readings("""
        SELECT station_id, s_no, kafka_partition, kafka_offset, battery_status,
          status_timestamp, humidity, temperature, wind_speed FROM u"""),
    "rain_alerts_stream": with_readings(f"""
        SELECT CAST(station_id AS VARCHAR) AS key, {_ALERT_JSON} AS value
        FROM r WHERE humidity > 70"""),
    "rain_alerts_valid": with_readings("""
        SELECT station_id, 'RAIN_DETECTED' AS alert_type, humidity, temperature, wind_speed,
          status_timestamp FROM u WHERE humidity > 70"""),
    "routed_messages": with_readings(_ROUTED),
    "evict_oldest": with_readings("""
        SELECT station_id, s_no, arrived_ms AS recorded_at FROM u
        WHERE (SELECT count(*) FROM u) > 500 ORDER BY arrived_ms, station_id, s_no LIMIT 50"""),
    "evict_older_than": with_readings(f"""
        SELECT station_id, s_no, arrived_ms AS recorded_at FROM u WHERE arrived_ms < {_SINCE}"""),

    "archive_roundtrip": with_readings(f"SELECT {_ARCHIVE} FROM u"),
    "archive_pruned": with_readings(f"""
        SELECT {_ARCHIVE} FROM u WHERE station_id = 3
          AND year({_SENT}) = 2024 AND month({_SENT}) = 1 AND day({_SENT}) = 10"""),
    "archive_humid": with_readings(f"""
        SELECT station_id, CAST(month({_SENT}) AS INT) AS month, CAST(day({_SENT}) AS INT) AS day,
          count(*) AS rainy, max(wind_speed) AS max_wind
        FROM u WHERE humidity > 70 GROUP BY ALL"""),
    "archive_compacted": with_readings(f"SELECT {_ARCHIVE} FROM u"),
    "archive_extreme": with_readings(f"""
        , x AS (SELECT *, CASE kafka_offset // 20 % 5 WHEN 1 THEN 185542587187199
            WHEN 3 THEN 253402300800 ELSE status_timestamp END AS sent
          FROM u WHERE kafka_offset // 20 % 5 NOT IN (0, 2))
        SELECT station_id, s_no, battery_status, sent AS status_timestamp, humidity, temperature, wind_speed,
          CAST(CASE sent WHEN 185542587187199 THEN 5881580 WHEN 253402300800 THEN 10000
            ELSE year(make_timestamp(sent * 1000000)) END AS INTEGER) AS year,
          CAST(CASE sent WHEN 185542587187199 THEN 7 WHEN 253402300800 THEN 1
            ELSE month(make_timestamp(sent * 1000000)) END AS INTEGER) AS month,
          CAST(CASE sent WHEN 185542587187199 THEN 11 WHEN 253402300800 THEN 1
            ELSE day(make_timestamp(sent * 1000000)) END AS INTEGER) AS day
        FROM x"""),
    "archive_undated": with_readings("""
        SELECT station_id, s_no, CASE kafka_offset // 20 % 5 WHEN 0 THEN 9223372036854775807
          ELSE 185542587187200 END AS status_timestamp, humidity
        FROM u WHERE kafka_offset // 20 % 5 IN (0, 2)"""),
    "station_counts": with_readings(
        "SELECT station_id, count(*) AS records FROM u GROUP BY station_id"),

    "storage_summary": with_readings("""
        SELECT count(DISTINCT (station_id, strftime(make_timestamp(status_timestamp * 1000000), '%Y-%m-%d')))
          AS files, true AS has_bytes, true AS none_empty FROM u"""),

    "latest_by_station": with_readings("SELECT key, value FROM latest"),
    "latest_upsert": with_readings("SELECT key, value FROM latest"),
    "compact_log": with_readings(f"""
        SELECT CAST(station_id AS VARCHAR) AS key,
          arg_max(value, (strftime({_SENT}, '%Y-%m-%d'), kafka_offset)) AS value
        FROM v GROUP BY station_id"""),
    "raw_vs_unique": with_readings("""
        SELECT count(*) AS raw_entries, count(DISTINCT station_id) AS unique_keys FROM v"""),
    "point_lookup": with_readings("SELECT key, value FROM latest WHERE key = '3'"),
    "lookup_hits": with_readings("""
        , asked AS (SELECT CAST(user_id % 12 + 1 AS VARCHAR) AS key FROM events)
        SELECT a.key, count(*) AS probes, count(l.value) AS hits,
          count(*) - count(l.value) AS misses
        FROM asked a LEFT JOIN latest l ON a.key = l.key GROUP BY a.key"""),
    "lookup_rows": with_readings("""
        , asked AS (SELECT CAST(user_id % 12 + 1 AS VARCHAR) AS key FROM events)
        SELECT a.key, CAST(length(l.value) AS INT) AS value_chars
        FROM asked a LEFT JOIN latest l ON a.key = l.key"""),
    "lookup_missing": with_readings("""
        SELECT DISTINCT CAST(user_id % 12 + 1 AS VARCHAR) AS key FROM events
        WHERE CAST(user_id % 12 + 1 AS VARCHAR) NOT IN (SELECT key FROM latest)"""),
    "reconcile": with_readings(f", {_EXPECTED.strip()} SELECT key, status FROM matched"),
    "reconcile_counts": with_readings(
        f", {_EXPECTED.strip()} SELECT status, count(*) AS keys FROM matched GROUP BY status"),
    "csv_export_roundtrip": with_readings("SELECT key, value FROM latest"),
    "csv_lines": with_readings("""
        SELECT '"' || key || '","' || replace(value, '"', '""') || '"' AS line FROM latest"""),
    "csv_fields": with_readings("""
        SELECT kafka_offset, '"' || replace(value, '"', '""') || '"' AS field FROM v"""),

    "dlq_list": with_dead_letters(f"""
        SELECT kafka_offset, failed_text AS failed_at, station, exception FROM dl
        WHERE dl_date = '{_DATE}' AND stage = 'ARCHIVE_WRITE' ORDER BY failed_at, kafka_offset"""),
    "dlq_by_date": with_dead_letters(f"""
        SELECT stage, kafka_offset, original_message FROM dl WHERE dl_date = '{_DATE}'"""),
    "dlq_partitions": with_dead_letters("SELECT DISTINCT dl_date, stage FROM dl ORDER BY 1, 2"),
    "dlq_view": with_dead_letters(f"""
        SELECT dl_date, stage, kafka_offset, original_message FROM dl
        WHERE dl_date = '{_DATE}' AND stage = 'LATEST_WRITE' ORDER BY kafka_offset LIMIT 1"""),
    "dlq_details": with_dead_letters("""
        , y AS (SELECT *, CASE s_no % 3 WHEN 1 THEN [stage || ' failed', 'gave up waiting']
            ELSE [stage || ' failed'] END AS reasons FROM dl)
        SELECT stage AS processing_stage, kafka_offset, kafka_partition, station_id,
          s_no AS sequence_number, failed_text AS failed_at, exception_type,
          lower(exception_type) AS exception_message,
          CAST(unnest(range(len(reasons))) AS INT) AS reason_pos, unnest(reasons) AS reason,
          CAST(length(original_message) AS INT) AS message_chars, original_message FROM y"""),
    "dlq_station": with_dead_letters("""
        SELECT dl_date, stage, kafka_offset, exception FROM dl WHERE station_id = 5"""),
    "dlq_search": with_dead_letters("""
        SELECT dl_date, stage, station, exception FROM dl
        WHERE regexp_matches(exception_type, 'timeout', 'i')"""),
    "dlq_stage_stats": with_dead_letters("""
        SELECT stage, count(*) AS messages,
          round(count(*) * 100e0 / (SELECT count(*) FROM dl), 1) AS percent FROM dl GROUP BY stage"""),
    "dlq_exception_stats": with_dead_letters("""
        SELECT exception, count(*) AS messages,
          round(count(*) * 100e0 / (SELECT count(*) FROM dl), 1) AS percent
        FROM dl GROUP BY exception"""),
    "dlq_stage_counts": with_dead_letters(f"""
        SELECT stage, count(*) AS messages FROM dl WHERE dl_date = '{_DATE}' GROUP BY stage"""),
    "dlq_top5": with_dead_letters("""
        , y AS (SELECT stage, row_number() OVER (PARTITION BY stage
              ORDER BY failed_at, kafka_offset, kafka_partition) AS nth,
            failed_at || '_offset_' || kafka_offset || '.json' AS file,
            count(*) OVER (PARTITION BY stage) AS messages FROM dl)
        SELECT stage, CAST(nth AS INT) AS nth, file, messages, greatest(messages - 5, 0) AS more
        FROM y WHERE nth <= 5"""),
    "dlq_replay_samples": with_dead_letters("""
        , y AS (SELECT * FROM dl WHERE stage = 'LATEST_WRITE')
        SELECT failed_at || '_offset_' || kafka_offset || '.json' AS file, kafka_offset,
          (SELECT count(*) FROM y) AS messages, greatest((SELECT count(*) FROM y) - 3, 0) AS more
        FROM y ORDER BY failed_at, kafka_offset, kafka_partition LIMIT 3"""),
    "dlq_export": with_dead_letters(f"""
        SELECT kafka_offset, original_message FROM dl WHERE dl_date = '{_DATE}'"""),
    "dlq_delete": with_dead_letters("""
        SELECT dl_date, stage, kafka_offset FROM dl
        WHERE exception_type IS DISTINCT FROM 'IOException'"""),
    "dlq_replay": with_readings("""
        SELECT station_id, count(*) AS readings, CAST(sum(s_no) AS BIGINT) AS sum_s_no
        FROM u GROUP BY station_id"""),

    "outage_intervals": with_outages(
        "SELECT subscriber, down_from_ms, down_to_ms FROM outages"),
    "silent_station_intervals": with_readings(f"""
        , y AS (SELECT station_id, arrived_ms, coalesce(
              lead(arrived_ms) OVER (PARTITION BY station_id ORDER BY arrived_ms), {_AS_OF}) AS next_ms
            FROM v)
        SELECT station_id, arrived_ms + 1800000 AS down_from_ms, next_ms AS down_to_ms
        FROM y WHERE next_ms - arrived_ms > 1800000"""),
    "missed_capture": with_outages("""
        SELECT subscriber, kafka_partition, kafka_offset, arrived_ms, value FROM missed"""),
    "missed_envelopes": with_outages("""
        SELECT missed_date, value AS "originalMessage", kafka_offset AS "kafkaOffset",
          kafka_partition AS "kafkaPartition", arrived_ms AS "messageTimestamp",
          arrived_ms AS "missedAtTimestamp", down_text AS "downDetectionTime" FROM missed"""),
    "missed_by_date": with_outages(f"""
        SELECT missed_date, value AS "originalMessage", kafka_offset AS "kafkaOffset",
          kafka_partition AS "kafkaPartition", arrived_ms AS "messageTimestamp",
          arrived_ms AS "missedAtTimestamp", down_text AS "downDetectionTime"
        FROM missed WHERE missed_date = '{_DATE}'"""),
    "missed_since": with_outages(f"""
        SELECT kafka_partition AS "kafkaPartition", kafka_offset AS "kafkaOffset",
          arrived_ms AS "missedAtTimestamp" FROM missed WHERE arrived_ms >= {_SINCE}"""),
    "missed_counts": with_outages(
        "SELECT missed_date, count(*) AS messages FROM missed GROUP BY missed_date"),
    "replay_union": with_readings("SELECT station_id, s_no, value FROM u"),
    "clear_replayed": with_outages(f"""
        SELECT missed_date, count(*) AS pending,
          (SELECT count(*) FROM missed WHERE missed_date = '{_DATE}') AS cleared_on_date
        FROM missed WHERE missed_date <> '{_DATE}' GROUP BY missed_date"""),
    "missed_statistics": with_outages("""
        SELECT count(DISTINCT missed_date) AS dates, count(*) AS messages, min(missed_date) AS first_date,
          max(missed_date) AS last_date FROM missed WHERE missed_date <> '2024-01-12'"""),
    "subscriber_status": with_outages(f"""
        , h AS (SELECT subscriber, max(beat_ms) AS last_ms FROM roster LEFT JOIN hb USING (subscriber)
            GROUP BY subscriber),
        o AS (SELECT subscriber, max(down_from_ms) AS last_down FROM outages GROUP BY subscriber),
        m AS (SELECT subscriber, count(*) FILTER (WHERE missed_date <> '2024-01-12') AS pending,
            count(*) FILTER (WHERE missed_date = '2024-01-12') AS replayed FROM missed GROUP BY subscriber)
        SELECT h.subscriber, coalesce({_AS_OF} - last_ms < 1800000, false) AS healthy,
          last_ms AS last_heartbeat_ms, {_AS_OF} - last_ms AS since_last_ms,
          last_down AS last_down_from_ms, coalesce(pending, 0) AS missed_pending,
          coalesce(replayed, 0) AS replayed_total
        FROM h LEFT JOIN o USING (subscriber) LEFT JOIN m USING (subscriber)"""),

    "op_latency": """
        WITH t AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'read' ELSE 'write' END AS op,
            event_id % 1000 + 1 AS ns FROM events)
        SELECT op, count(*) AS ops, CAST(sum(ns) AS BIGINT) AS total_ns,
          CAST(sum(ns) AS DOUBLE) / count(*) AS avg_ns, min(ns) AS min_ns, max(ns) AS max_ns,
          count(*) / (CAST(sum(ns) AS DOUBLE) / 1e9) AS ops_per_second FROM t GROUP BY op""",
    "hit_rate": """
        SELECT count(*) FILTER (event_id % 51 <> 0) AS hits,
          count(*) FILTER (event_id % 51 = 0) AS misses,
          count(*) FILTER (event_id % 51 <> 0) * 100e0 / count(*) AS hit_rate
        FROM events WHERE event_id % 2 = 0""",
    "openmeteo_normalised": """
        WITH g AS (SELECT event_id, ts, user_id % 10 + 1 AS station_id,
            event_id % 37 = 0 AS bare, event_id % 5 = 0 AS calm, value,
            CAST(props->>'k' AS INT) AS k FROM events
            WHERE event_id % 50 <> 0 AND (event_id % 37 = 0 OR event_id % 41 <> 0))
        SELECT station_id, row_number() OVER (PARTITION BY station_id ORDER BY ts, CASE WHEN bare THEN 0 ELSE k END) AS s_no,
          'high' AS battery_status, CAST(floor(epoch(ts)) AS BIGINT) AS status_timestamp,
          CASE WHEN bare THEN 0 ELSE k END AS humidity,
          CASE WHEN bare THEN 0 ELSE CAST(30 + (event_id * 7) % 91 AS INT) END AS temperature,
          CASE WHEN bare OR calm THEN 0 ELSE CAST(floor(value) AS INT) END AS wind_speed
        FROM g""",
    "lost_readings": with_readings(f"""
        , {_RESTARTED.strip()},
        z AS (SELECT *, 1 + sum(CASE WHEN before > n THEN 1 ELSE 0 END) OVER (
            PARTITION BY station_id ORDER BY kafka_offset) AS run FROM p)
        SELECT station_id, CAST(run AS BIGINT) AS run, min(n) AS first_s_no, max(n) AS last_s_no,
          count(DISTINCT n) AS received, max(n) - min(n) + 1 - count(DISTINCT n) AS lost
        FROM z GROUP BY station_id, run"""),
    "gap_list": with_readings(f"""
        , {_RESTARTED.strip()}
        SELECT station_id, before + 1 AS gap_from, n - 1 AS gap_to, n - before - 1 AS missing
        FROM p WHERE n - before > 1"""),
    "key_conflicts": with_readings("""
        , y AS (SELECT CASE station_id WHEN 10 THEN 9 ELSE station_id END AS station_id, s_no,
            replace(value, '"station_id":10,', '"station_id":9,') AS value FROM v)
        SELECT station_id, s_no, count(DISTINCT value) AS payloads, count(*) AS arrivals
        FROM y GROUP BY station_id, s_no HAVING count(DISTINCT value) > 1"""),
    "battery_share": with_readings("""
        SELECT station_id, battery_status, count(*) AS n,
          round(count(*) * 100e0 / sum(count(*)) OVER (PARTITION BY station_id), 1) AS percent
        FROM u GROUP BY station_id, battery_status"""),
    "display_fields": with_readings(f"""
        SELECT kafka_offset, station_id || ':' || s_no AS display_key,
          strftime({_SENT}, '%Y-%m-%d %H:%M:%S') AS sent_at,
          CASE WHEN s_no % 3 = 0 THEN 'bad_name'
               ELSE strftime({_SENT}, '%Y-%m-%d') || ' 10:11:12' END AS segment_time,
          ((humidity * 10 + 4) // 8 // 10) || '.' || ((humidity * 10 + 4) // 8 % 10) AS eighth
        FROM v"""),

    "stream_alerts": with_readings(f"""
        SELECT CAST(station_id AS VARCHAR) AS key, {_ALERT_JSON} AS value
        FROM r WHERE humidity > 70"""),
    "stream_invalid": with_readings("""
        SELECT kafka_offset, value AS original_message FROM r
        WHERE humidity > 100 OR battery_status = 'dead'"""),
    "stream_dedup": with_readings("SELECT station_id, s_no, value FROM u"),
    "stream_fanout": with_readings(f"SELECT {_ARCHIVE} FROM u"),
    "stream_routed": with_readings(_ROUTED),
    "stream_latest": with_readings("SELECT key, value FROM latest"),
    "stream_state": with_readings("SELECT station_id, s_no FROM u"),
    "stream_dlq": with_readings("""
        SELECT 'ARCHIVE_WRITE' AS stage, 'OSError' AS exception_type,
          'disk full' AS exception_message, station_id, s_no AS sequence_number,
          value AS original_message, 'ARCHIVE_WRITE failed: disk full' AS reason FROM u"""),
    "stream_late": with_readings("SELECT station_id, s_no, value FROM u"),
    "stream_replay": with_readings(f"SELECT {_ARCHIVE} FROM u"),
    "stream_replay_latest": with_readings("SELECT key, value FROM latest"),
    "stream_replay_ledger": """
        SELECT 'stored' AS outcome, CAST(1 AS INTEGER) AS attempt, count(*) > 0 AS some_failed,
          true AS all_replayed, CAST(0 AS BIGINT) AS second_run, CAST(0 AS BIGINT) AS pending FROM events""",
    "stream_missed_replay": with_readings("""
        SELECT station_id, count(*) AS readings, CAST(sum(s_no) AS BIGINT) AS sum_s_no,
          nullif(count(*) FILTER (WHERE humidity > 70), 0) AS routed
        FROM u GROUP BY station_id"""),
    "stream_silent": with_readings("""
        , y AS (SELECT station_id, copy, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (
              PARTITION BY station_id ORDER BY ts, copy) AS before FROM v),
        z AS (SELECT *, sum(CASE WHEN us - before <= 14400000000 THEN 0 ELSE 1 END) OVER (
              PARTITION BY station_id ORDER BY us, copy ROWS UNBOUNDED PRECEDING) AS session FROM y)
        SELECT station_id, count(*) AS readings, max(us) AS last_seen_us,
          max(us) + 14400000000 AS silent_from_us
        FROM z GROUP BY station_id, session
        HAVING max(us) + 14400000000 <= (SELECT max(us) FROM z) - 3600000000"""),
    "stream_silent_clock": with_readings("""
        , w AS (SELECT unnest(range(1, 13)) AS station_id)
        SELECT w.station_id, count(v.station_id) AS readings, max(epoch_us(ts)) AS last_seen_us
        FROM w LEFT JOIN v USING (station_id) GROUP BY w.station_id"""),
    "stream_conflicts": with_readings("""
        , y AS (SELECT CASE station_id WHEN 10 THEN 9 ELSE station_id END AS station_id, s_no,
            replace(value, '"station_id":10,', '"station_id":9,') AS value FROM v)
        SELECT station_id, s_no, count(DISTINCT value) AS payloads
        FROM y GROUP BY station_id, s_no HAVING count(DISTINCT value) > 1"""),
    "stream_forget": with_readings("""
        , f AS (SELECT station_id, s_no FROM u WHERE s_no % 50 = 0 OR station_id = 3),
        o AS (SELECT station_id, s_no, 'accepted' AS outcome FROM u
          UNION ALL SELECT *, 'forgotten' FROM f UNION ALL SELECT *, 'accepted' FROM f)
        SELECT station_id, outcome, count(*) AS messages, CAST(sum(s_no) AS BIGINT) AS sum_s_no
        FROM o GROUP BY station_id, outcome"""),
}
