"""Parameters that change results, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

# Thresholds, bounds and names that define the results.
RAIN_HUMIDITY_THRESHOLD = 70
HUMIDITY_RANGE = (0, 100)
TEMPERATURE_RANGE = (-50, 150)
MIN_WIND_SPEED = 0
BATTERY_STATUSES = ("low", "medium", "high")

READINGS_TOPIC = "weather-readings"
ALERT_JOB_TOPIC = "raining-alerts"
ROUTED_RAIN_TOPIC = "rain-alerts"
INVALID_TOPIC = "weather-invalid-messages"
SILENCE_CHANNEL = "silent-stations"
RAIN_ALERT_TYPE = "RAIN_DETECTED"

STAGE_ARCHIVE = "ARCHIVE_WRITE"
STAGE_LATEST = "LATEST_WRITE"
STAGE_UNKNOWN = "UNKNOWN"

MAX_OFFSETS_PER_BATCH = 20_000_000
DEDUP_CAPACITY = 100_000
HEARTBEAT_MS = 5_000
HEARTBEAT_TIMEOUT_MS = 15_000


@dataclass(frozen=True)
class PipelineSettings:
    """Knobs of the streaming job.

    ``dedup_horizon`` bounds the de-duplication state: a redelivery later than
    this after the first arrival is accepted again, so keep it above the longest
    time the transport can take to redeliver. ``collapse_copies`` drops copies
    inside each task before the shuffle, so that one message redelivered without
    end cannot fill a task; switch it off where that cannot happen.
    ``archive_rows_per_task`` bounds what one task writes to one directory, and
    ``archive_rows_per_file`` (0: no bound) what it writes to one file.
    ``max_offsets`` caps one micro-batch, not the data: 10,000 suits a single node.
    ``min_partitions`` above the topic's partition count lets several tasks read one hot
    partition. ``state_partitions`` is fixed by the first start of a query.
    """

    dedup_horizon: str = "6 hours"
    rain_threshold: int = RAIN_HUMIDITY_THRESHOLD
    collapse_copies: bool = True
    archive_rows_per_task: int = 1_000_000
    archive_rows_per_file: int = 0
    compact_latest_every: int = 100
    max_offsets: int = MAX_OFFSETS_PER_BATCH
    min_partitions: int | None = None
    state_partitions: int | None = None
    silence_ms: int = HEARTBEAT_TIMEOUT_MS
