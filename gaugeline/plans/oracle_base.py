"""Common table expressions the oracle queries build on (DuckDB dialect)."""

_READINGS = """
e AS (SELECT event_id, ts, user_id, value AS val, CAST(props->>'k' AS INT) AS k FROM events),
b AS (SELECT event_id, ts, user_id % 10 + 1 AS station_id,
        row_number() OVER (PARTITION BY user_id % 10 ORDER BY event_id) AS s_no,
        CASE WHEN event_id % 101 = 5 THEN 'dead' WHEN event_id % 10 < 3 THEN 'low'
             WHEN event_id % 10 < 7 THEN 'medium' ELSE 'high' END AS battery_status,
        CASE WHEN event_id % 97 = 11 THEN 130 ELSE k END AS humidity,
        CAST(30 + (event_id * 7) % 91 AS INT) AS temperature,
        CAST(least(floor(val), 150) AS INT) AS wind_speed FROM e),
s AS (SELECT * FROM b WHERE event_id % 10 <> 3),
d AS (SELECT *, 0 AS copy FROM s UNION ALL SELECT *, 1 AS copy FROM s WHERE event_id % 25 = 0),
q AS (SELECT *, event_id * 2 + copy AS kafka_offset,
        CAST(station_id - 1 AS INT) AS kafka_partition,
        CAST(floor(epoch(ts)) AS BIGINT) AS status_timestamp,
        epoch_us(ts) // 1000 AS arrived_ms FROM d),
r AS (SELECT *, '{"station_id":' || station_id || ',"s_no":' || s_no || ',"battery_status":"'
        || battery_status || '","status_timestamp":' || status_timestamp
        || ',"weather":{"humidity":' || humidity || ',"temperature":' || temperature
        || ',"wind_speed":' || wind_speed || '}}' AS value FROM q),
v AS (SELECT * FROM r WHERE humidity <= 100 AND battery_status <> 'dead'),
u AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY station_id, s_no ORDER BY kafka_offset) = 1),
latest AS (SELECT CAST(station_id AS VARCHAR) AS key, arg_max(value, kafka_offset) AS value
        FROM v GROUP BY station_id)
"""

_DEAD = """
l0 AS (SELECT value AS original_message, status_timestamp * 1000 AS failed_at, kafka_offset,
        kafka_partition,
        CASE WHEN s_no % 40 = 0 THEN 'ARCHIVE_WRITE' ELSE 'LATEST_WRITE' END AS stage,
        CASE s_no % 3 WHEN 0 THEN 'IOException' WHEN 1 THEN 'TimeoutException' END AS exception_type,
        CASE WHEN s_no % 100 <> 0 THEN station_id END AS station_id, s_no
      FROM u WHERE s_no % 20 = 0),
dl AS (SELECT *, strftime(make_timestamp(failed_at * 1000), '%Y-%m-%d') AS dl_date,
        strftime(make_timestamp(failed_at * 1000), '%Y-%m-%d %H:%M:%S') AS failed_text,
        coalesce(station_id, -1) AS station, coalesce(exception_type, 'Unknown') AS exception
      FROM l0)
"""

_OUTAGES = """
roster AS (SELECT CAST(unnest(range(4)) AS VARCHAR) AS subscriber, 1704067200000 AS enrolled_ms),
hb AS (SELECT CAST(user_id % 4 AS VARCHAR) AS subscriber, epoch_us(ts) // 1000 AS beat_ms FROM events
      WHERE (epoch_us(ts) // 3600000000 + user_id % 4 * 5) % 24 <> 0 AND user_id % 4 < 3
        AND NOT (user_id % 4 = 2 AND epoch_us(ts) // 1000 >= 1706140800000)),
gaps AS (SELECT subscriber, beat_ms, lead(beat_ms) OVER (PARTITION BY subscriber ORDER BY beat_ms) AS next_ms
      FROM (SELECT * FROM hb UNION ALL SELECT subscriber, enrolled_ms - 1800000 FROM roster)),
outages AS (SELECT subscriber, beat_ms + 1800000 AS down_from_ms, next_ms AS down_to_ms
      FROM gaps WHERE next_ms - beat_ms > 1800000 OR (next_ms IS NULL AND beat_ms + 1800000 <= 1706659200000)),
missed AS (SELECT r.*, o.subscriber, o.down_from_ms,
        strftime(make_timestamp(arrived_ms * 1000), '%Y-%m-%d') AS missed_date,
        strftime(make_timestamp(o.down_from_ms * 1000), '%Y-%m-%d %H:%M:%S') AS down_text
      FROM r JOIN outages o ON CAST(r.kafka_partition % 4 AS VARCHAR) = o.subscriber
       AND r.arrived_ms >= o.down_from_ms AND r.arrived_ms < coalesce(o.down_to_ms, 1706659200001))
"""


def with_readings(sql: str) -> str:
    return f"WITH {_READINGS.strip()}\n{sql.strip()}"


def with_dead_letters(sql: str) -> str:
    return f"WITH {_READINGS.strip()},\n{_DEAD.strip()}\n{sql.strip()}"


def with_outages(sql: str) -> str:
    return f"WITH {_READINGS.strip()},\n{_OUTAGES.strip()}\n{sql.strip()}"
