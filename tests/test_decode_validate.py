"""Binding and validation edges, one literal expectation each."""

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.alerts import alert_messages, alert_rows
from gaugeline.operators.decode import PARSE_FAILED, decode
from gaugeline.operators.dedup import keep_first
from gaugeline.operators.routing import routed_messages
from gaugeline.operators.validate import accepted, is_valid, rejected, validation_errors

GOLDEN = [
    '{"station_id":1,"s_no":1,"battery_status":"high","status_timestamp":1716076800,'
    '"weather":{"humidity":35,"temperature":25,"wind_speed":10}}',
    '{"station_id":3,"s_no":1,"battery_status":"medium","status_timestamp":1716076800,'
    '"weather":{"humidity":82,"temperature":28,"wind_speed":12}}',
    '{"station_id":5,"s_no":1,"battery_status":"low","status_timestamp":1716076900,'
    '"weather":{"humidity":91,"temperature":35,"wind_speed":20}}',
]
RULE_3B = "battery_status must be one of [low, medium, high], got: '%s'"


def errors_of(arrivals):
    rows = decode(arrivals).select("kafka_offset", validation_errors().alias("e")) \
        .orderBy("kafka_offset").collect()
    return [r.e for r in rows]


def test_golden_messages_alert_twice(arrivals_of):
    decoded = decode(arrivals_of(GOLDEN))
    rows = alert_rows(keep_first(accepted(decoded))).orderBy("station_id").collect()
    assert [tuple(r) for r in rows] == [
        (3, "RAIN_DETECTED", 82, 28, 12, 1716076800),
        (5, "RAIN_DETECTED", 91, 35, 20, 1716076900),
    ]
    raw = alert_messages(decoded).collect()
    assert [r.value for r in raw] == [
        '{"station_id":3,"alert_type":"RAIN_DETECTED","humidity":82,"temperature":28,'
        '"wind_speed":12,"status_timestamp":1716076800}',
        '{"station_id":5,"alert_type":"RAIN_DETECTED","humidity":91,"temperature":35,'
        '"wind_speed":20,"status_timestamp":1716076900}',
    ]


def test_routed_messages_keep_the_payload(arrivals_of):
    rows = routed_messages(accepted(decode(arrivals_of(GOLDEN)))).collect()
    assert [(r.topic, r.key, r.value) for r in rows] == [
        ("rain-alerts", "station-3", GOLDEN[1]), ("rain-alerts", "station-5", GOLDEN[2])]


def test_rule_boundaries(arrivals_of, reading_json):
    cases = [
        (reading_json(weather={"humidity": 0}), []),
        (reading_json(weather={"humidity": 100}), []),
        (reading_json(weather={"humidity": -1}),
         ["humidity must be between 0 and 100, got: -1"]),
        (reading_json(weather={"humidity": 101}),
         ["humidity must be between 0 and 100, got: 101"]),
        (reading_json(weather={"temperature": -50}), []),
        (reading_json(weather={"temperature": 150}), []),
        (reading_json(weather={"temperature": -51}),
         ["temperature must be between -50°F and 150°F, got: -51°F"]),
        (reading_json(weather={"temperature": 151}),
         ["temperature must be between -50°F and 150°F, got: 151°F"]),
        (reading_json(weather={"wind_speed": 0}), []),
        (reading_json(weather={"wind_speed": -1}),
         ["wind_speed must be non-negative (km/h), got: -1"]),
        (reading_json(station_id=0), ["station_id must be positive, got: 0"]),
        (reading_json(s_no=0), []),
        (reading_json(s_no=-1), ["s_no must be non-negative, got: -1"]),
        (reading_json(status_timestamp=0), ["status_timestamp must be positive, got: 0"]),
        (reading_json(battery_status="LOW"), []),
        (reading_json(battery_status="dead"), [RULE_3B % "dead"]),
        (reading_json(battery_status="\t"), ["battery_status is null or empty"]),
        (reading_json(battery_status=""), ["battery_status is null or empty"]),
        (reading_json(battery_status=None), ["battery_status is null or empty"]),
        (reading_json(battery_status=7), [RULE_3B % "7"]),
        (reading_json(battery_status=True), [RULE_3B % "true"]),
        ("{}", ["station_id must be positive, got: 0", "battery_status is null or empty",
                "status_timestamp must be positive, got: 0", "weather data is null"]),
        ("null", ["WeatherReading is null"]),
        (" null\n", ["WeatherReading is null"]),
    ]
    arrivals = arrivals_of([text for text, _ in cases])
    assert errors_of(arrivals) == [expected for _, expected in cases]
    # The fast validity test agrees with the full error list.
    assert decode(arrivals).where(
        is_valid() != (F.size(validation_errors()) == 0)).count() == 0


def test_all_violations_are_reported_in_order(arrivals_of, reading_json):
    bad = reading_json(station_id=-4, s_no=-2, battery_status="dead", status_timestamp=-1,
                       weather={"humidity": 130, "temperature": 999, "wind_speed": -3})
    assert errors_of(arrivals_of([bad])) == [[
        "station_id must be positive, got: -4",
        "s_no must be non-negative, got: -2",
        RULE_3B % "dead",
        "status_timestamp must be positive, got: -1",
        "humidity must be between 0 and 100, got: 130",
        "temperature must be between -50°F and 150°F, got: 999°F",
        "wind_speed must be non-negative (km/h), got: -3",
    ]]


PARSE_FAILURES = [
    "not json", '{"station_id":1', "[1]", '[{"station_id":1}]', "", None, "5", '"x"',
    "{'station_id':1}", '{"station_id":true}', '{"weather":"x"}', '{"weather":""}',
    '{"weather":[]}', '{"weather":{"humidity":99999999999}}', '{"station_id":1e40}',
    '{"station_id":{"a":1}}', '{"weather":{"humidity":[1]}}', '{"station_id":NaN}',
    '{"battery_status":{"a":1}}', '{"battery_status":["low"]}', '{"station_id":"abc"}',
    '{"station_id":007}', '{"station_id":1 /* one */}',
]


@pytest.mark.parametrize("chunk", [PARSE_FAILURES])
def test_parse_failures(arrivals_of, chunk):
    rows = rejected(decode(arrivals_of(chunk))).orderBy("kafka_offset").collect()
    assert [r.value for r in rows] == chunk
    assert all(r.parse_failed for r in rows), [r.value for r in rows if not r.parse_failed]
    assert all(r.validation_errors == [PARSE_FAILED] for r in rows)


def test_coercions(arrivals_of):
    texts = [
        '{"station_id":"7","s_no":2,"weather":{"humidity":70.9}}',
        '{"station_id":7.9,"s_no":"","weather":{}}',
        '{"station_id":1e3,"weather":{"temperature":-3.9}}',
        '{"station_id":null,"extra":[1,{"a":2}],"weather":null}',
        '{"station_id":1,"station_id":2}',
        '{"station_id":4} trailing',
        '{"STATION_ID":5}',
    ]
    rows = decode(arrivals_of(texts)).orderBy("kafka_offset").collect()
    assert not any(r.parse_failed for r in rows)
    got = [(r.station_id, r.s_no, tuple(r.weather) if r.weather else None) for r in rows]
    assert got == [
        (7, 2, (70, 0, 0)), (7, 0, (0, 0, 0)), (1000, 0, (0, -3, 0)), (0, 0, None),
        (2, 0, None), (4, 0, None), (0, 0, None),
    ]


def test_rain_threshold_is_strict(arrivals_of, reading_json):
    texts = [reading_json(weather={"humidity": h}) for h in (70, 71, 130)]
    texts += ["not json", reading_json(weather=None)]
    decoded = decode(arrivals_of(texts, key="1"))
    assert alert_messages(decoded).count() == 2
    assert alert_rows(accepted(decoded)).count() == 1


def test_message_is_parsed_once(arrivals_of):
    rows = alert_rows(accepted(decode(arrivals_of(GOLDEN))))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2  # strict, and the fallback inside CASE
