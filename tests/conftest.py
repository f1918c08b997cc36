import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("gaugeline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def arrivals_of(spark):
    """Arrivals from payloads, offsets in list order."""
    def make(payloads, key=None):
        rows = [(key, text, 0, n, 1_700_000_000 + n) for n, text in enumerate(payloads)]
        return spark.createDataFrame(
            rows, "key STRING, value STRING, kafka_partition INT, kafka_offset BIGINT, s BIGINT"
        ).selectExpr("key", "value", "kafka_partition", "kafka_offset",
                     "timestamp_seconds(s) AS arrival_ts")
    return make


@pytest.fixture
def reading_json():
    import json

    def make(**changes):
        weather = dict(humidity=50, temperature=20, wind_speed=5)
        weather.update(changes.pop("weather", {}) or {})
        reading = dict(station_id=1, s_no=1, battery_status="high",
                       status_timestamp=1716076800, weather=weather)
        reading.update(changes)
        return json.dumps(reading)
    return make
