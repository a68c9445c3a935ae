import json

import pytest
from pyspark.sql import functions as F
from helpers import message, messages, reading

from gaugeline.operators import alerts, readings

OK = reading(station=3, s_no=9, battery="high", time=1700000000, humidity=71, temp=80, wind=4)
FLAT = (3, 9, "high", 1700000000, 71, 80, 4)


def text(**changes):
    """The good reading as text, with top-level fields replaced by raw JSON (None removes)."""
    body = {k: json.dumps(v) for k, v in OK.items()} | changes
    return "{" + ",".join(f'"{k}":{v}' for k, v in body.items() if v is not None) + "}"


def weather(**changes):
    body = {k: json.dumps(v) for k, v in OK["weather"].items()} | changes
    return text(weather="{" + ",".join(f'"{k}":{v}' for k, v in body.items() if v is not None) + "}")


def flat(**changes):
    names = readings.READING_COLUMNS
    return tuple(changes.get(n, v) for n, v in zip(names, FLAT))


VALID = {
    "plain": (text(), flat()),
    "extra field": (text(extra='{"a":[1,{"b":2}]}'), flat()),
    "trailing junk": (text() + " junk", flat()),
    "two objects": (text() + text(s_no="5"), flat()),
    "spaces": ("  " + text() + "\n", flat()),
    "duplicate key": (text()[:-1] + ',"s_no":12}', flat(s_no=12)),
    "wrong then right duplicate": ('{"s_no":"x",' + text()[1:], flat()),
    "null station": (text(station_id="null"), flat(station_id=0)),
    "null battery": (text(battery_status="null"), flat(battery_status="null")),
    "null humidity": (weather(humidity="null"), flat(humidity=0)),
    "numeric text": (text(s_no='"12"'), flat(s_no=12)),
    "padded numeric text": (text(s_no='" 12 "'), flat(s_no=12)),
    "fraction": (weather(humidity="70.9"), flat(humidity=70)),
    "negative fraction": (weather(humidity="-70.9"), flat(humidity=-70)),
    "fraction text": (weather(humidity='"12.7"'), flat(humidity=12)),
    "exponent": (weather(humidity="1e2"), flat(humidity=100)),
    "true": (text(s_no="true"), flat(s_no=1)),
    "false": (text(s_no="false"), flat(s_no=0)),
    "word": (weather(humidity='"abc"'), flat(humidity=0)),
    "empty text": (weather(humidity='""'), flat(humidity=0)),
    "object as number": (weather(humidity="{}"), flat(humidity=0)),
    "array as number": (text(s_no="[1]"), flat(s_no=0)),
    "NaN text": (weather(humidity='"NaN"'), flat(humidity=0)),
    "long": (text(s_no="9007199254740993"), flat(s_no=9007199254740993)),
    "int limit": (weather(humidity="2147483647"), flat(humidity=2147483647)),
    "battery number": (text(battery_status="7"), flat(battery_status="7")),
    "battery fraction": (text(battery_status="70.50"), flat(battery_status="70.5")),
    "battery true": (text(battery_status="true"), flat(battery_status="true")),
    "battery object": (text(battery_status='{"a":1}'), flat(battery_status="")),
    "battery array": (text(battery_status="[1]"), flat(battery_status="")),
    "battery empty": (text(battery_status='""'), flat(battery_status="")),
    "battery looks like number": (text(battery_status='"7.50"'), flat(battery_status="7.50")),
    "battery looks like object": (text(battery_status='"{a}"'), flat(battery_status="{a}")),
    "battery unicode": (text(battery_status='"\\u00e9\\n"'), flat(battery_status="é\n")),
}

INVALID = {
    **{f"no {name}": text(**{name: None}) for name in OK},
    **{f"no {name}": weather(**{name: None}) for name in OK["weather"]},
    "null weather": text(weather="null"),
    "text weather": text(weather='"x"'),
    "array weather": text(weather="[]"),
    "truncated": text()[:-1],
    "truncated early": text()[:40],
    "array root": f"[{text()}]",
    "scalar root": "3",
    "text root": '"x"',
    "null root": "null",
    "not json": "not json",
    "single quotes": text().replace('"', "'"),
    "NaN": weather(humidity="NaN"),
    "leading zero": weather(humidity="012"),
    "empty": "",
    "blank": "  ",
    "NULL": None,
    "beyond int": weather(humidity="2147483648"),
    "below int": weather(wind_speed="-2147483649"),
    "beyond int as text": weather(humidity='"3000000000"'),
    "beyond long": text(s_no="9223372036854775808"),
    "far beyond long": text(station_id="1e30"),
}


@pytest.fixture(scope="module")
def parsed(spark):
    cases = {**{k: v[0] for k, v in VALID.items()}, **INVALID}
    raw = messages(spark, [message(v, key=k) for k, v in cases.items()])
    found = readings.parse_readings(raw).collect()
    assert len(found) == len(cases)
    return {r["key"]: r for r in found}


@pytest.mark.parametrize("case", VALID)
def test_accepted(parsed, case):
    row = parsed[case]
    assert row["valid"]
    assert tuple(row[c] for c in readings.READING_COLUMNS) == VALID[case][1]


@pytest.mark.parametrize("case", INVALID)
def test_dead_lettered(parsed, case):
    row = parsed[case]
    assert row["valid"] is False
    assert row["value"] == INVALID[case]
    assert all(row[c] is None for c in readings.READING_COLUMNS)


def test_split_keeps_every_message(spark):
    raw = messages(spark, [message(v, i) for i, v in enumerate([*INVALID.values(), text()])])
    parsed = readings.parse_readings(raw)
    good, bad = readings.valid_readings(parsed), readings.invalid_messages(parsed)
    assert good.count() == 1
    assert bad.count() == len(INVALID)
    assert bad.columns == raw.columns
    assert "value" not in good.columns


def test_filter_does_not_repeat_the_parse(spark):
    from helpers import plan

    raw = messages(spark, [message(text())])
    shown = plan(readings.parse_readings(raw).where("valid AND humidity > 1"))
    # One typed and one lenient read, and no filter below the generator.
    assert shown.count("from_json") == 2


def test_round_trip(spark):
    raw = messages(spark, [message(text())])
    good = readings.valid_readings(readings.parse_readings(raw))
    sent = readings.to_messages(good).first()
    assert (sent["key"], json.loads(sent["value"])) == ("3", OK)
    assert list(json.loads(sent["value"])) == list(OK)
    stored = json.loads(good.select(readings.flat_json().alias("j")).first()["j"])
    assert tuple(stored) == tuple(readings.READING_COLUMNS)


def humidity_of(value):
    return weather(humidity=value)


ALERT_CASES = {
    "69": (humidity_of("69"), False),
    "70": (humidity_of("70"), False),
    "70.9": (humidity_of("70.9"), False),
    "71": (humidity_of("71"), True),
    "text 80": (humidity_of('"80"'), True),
    "null": (humidity_of("null"), False),
    "missing": (weather(humidity=None), False),
    "no battery": (text(battery_status=None), True),
    "only humidity": ('{"weather":{"humidity":99}}', True),
    "weather text": (text(weather='"x"'), False),
    "weather null": (text(weather="null"), False),
    "truncated": (text()[:-1], False),
    "array root": (f"[{text()}]", False),
    "empty": ("", False),
    "NULL": (None, False),
    "beyond int": (humidity_of("3000000000"), False),
}


def test_alerts_raised(spark):
    raw = messages(spark, [message(v, key=k) for k, (v, _) in ALERT_CASES.items()])
    raised = {r["key"]: json.loads(r["value"]) for r in alerts.alert_messages(raw).collect()}
    assert set(raised) == {k for k, (_, expected) in ALERT_CASES.items() if expected}
    assert raised["71"] == {
        "event": "CRITICAL_RAIN_ALERT",
        "station_id": 3,
        "s_no": 9,
        "humidity": 71,
        "status": "RAIN_DETECTED",
    }
    assert raised["only humidity"]["station_id"] == 0


def test_alert_text_exact_and_threshold(spark):
    raw = messages(spark, [message(text())])
    assert alerts.alert_messages(raw).first()["value"] == (
        '{"event":"CRITICAL_RAIN_ALERT","station_id":3,"s_no":9,"humidity":71,'
        '"status":"RAIN_DETECTED"}'
    )
    assert alerts.alert_messages(raw, threshold=71).count() == 0


def test_unreadable_message_has_fallback_alert(spark):
    raw = messages(spark, [message("{broken")])
    texts = alerts.read_humidity(raw).select(alerts.alert_json().alias("a"))
    assert texts.first()["a"] == '{"event":"UNKNOWN_ALERT_ERROR"}'


ALERT_TEXTS = {
    "full": ('{"event":"E","station_id":1,"s_no":2,"humidity":80,"status":"S"}', ("E", 1, 2, 80, "S")),
    "missing": ('{"event":"E"}', ("E", 0, 0, 0, "")),
    "nulls": ('{"event":null,"station_id":null,"status":"S"}', ("null", 0, 0, 0, "S")),
    "loose": ('{"event":5,"station_id":"7","s_no":2.9,"humidity":"x","status":[1]}', ("5", 7, 2, 0, "")),
    "blank": (" ", ("", 0, 0, 0, "")),
    "array": ("[1]", ("", 0, 0, 0, "")),
    "scalar": ("5", ("", 0, 0, 0, "")),
    "broken": ('{"event":"E"', None),
    "NULL": (None, None),
}


def test_alert_texts(spark):
    raw = messages(spark, [message(v, key=k) for k, (v, _) in ALERT_TEXTS.items()])
    parsed = alerts.parse_alerts(raw)
    good = {
        r["key"]: tuple(r[c] for c in alerts.ALERT_COLUMNS)
        for r in alerts.alert_records(parsed).collect()
    }
    assert good == {k: v for k, (_, v) in ALERT_TEXTS.items() if v is not None}
    bad = alerts.unreadable_alerts(parsed)
    assert {r["key"] for r in bad.collect()} == {"broken", "NULL"}
    assert parsed.where(F.col("valid").isNull()).count() == 0
