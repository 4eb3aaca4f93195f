"""Decoding, parsing, filtering and encoding of single records."""

import json

import pytest
from pyspark.sql import functions as F

from keycadence.operators import events as ev
from keycadence.schema import EVENT_SCHEMA

FULL = {
    "eventType": "KEYSTROKE", "userId": "ann", "timestamp": "2024-01-01T00:00:00.000Z",
    "event_id": "e1", "server_timestamp": "2024-01-01T00:00:00.100000",
    "data": {"accuracy": 97, "wpm": 45, "correct": 9, "total": 10, "timestamp": 1704067200000,
             "timeRemaining": 12},
}


def _with_wpm(text):
    return '{"eventType": "KEYSTROKE", "userId": "ann", "data": {"wpm": %s, "accuracy": 90}}' % text


GOLDEN = {
    "full": json.dumps(FULL),
    "wpm_fraction": _with_wpm("45.5"),
    "wpm_exponent": _with_wpm("1e1"),
    "wpm_text": _with_wpm('"45"'),
    "wpm_overflow": _with_wpm("99999999999"),
    "wpm_nan": _with_wpm("NaN"),
    "user_number": '{"eventType": "KEYSTROKE", "userId": 7, "data": {"wpm": 3}}',
    "data_null": '{"eventType": "KEYSTROKE", "userId": "ann", "data": null}',
    "data_absent": '{"eventType": "KEYSTROKE", "userId": "ann"}',
    "key_case": '{"eventtype": "OTHER", "eventType": "KEYSTROKE", "userId": "ann"}',
    "escaped": '{"eventType": "\\u004bEYSTROKE", "userId": "esc", "data": {"wpm": 8}}',
    "not_json": "not json KEYSTROKE",
    "array": "[]",
    "blank": "",
    "null": None,
}


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(name, None if text is None else bytearray(text, "utf-8")) for name, text in GOLDEN.items()]
    records = spark.createDataFrame(rows, "name string, value binary")
    return ev.decode_values(records, keep=["name"])


@pytest.fixture(scope="module")
def parsed(decoded):
    rows = ev.parse_events(decoded, keep=["name"]).collect()
    assert len(rows) == len(GOLDEN)
    return {r.name: r for r in rows}


def test_full_record(parsed):
    row = parsed["full"]
    assert [row[f] for f in EVENT_SCHEMA.names[:-1]] == [FULL[f] for f in EVENT_SCHEMA.names[:-1]]
    data = row.data.asDict()
    assert data == {
        "accuracy": 97, "wpm": 45, "correct": 9, "total": 10, "finalWPM": None,
        "finalAccuracy": None, "quote": None, "timestamp": 1704067200000.0,
    }


@pytest.mark.parametrize(
    "name", ["wpm_fraction", "wpm_exponent", "wpm_text", "wpm_overflow", "wpm_nan"]
)
def test_bad_number_only_loses_the_field(parsed, name):
    row = parsed[name]
    assert (row.eventType, row.userId, row.data.wpm, row.data.accuracy) == (
        "KEYSTROKE", "ann", None, 90)


def test_other_golden_rows(parsed):
    assert parsed["user_number"].userId == "7"
    assert parsed["data_null"].data is None and parsed["data_absent"].data is None
    assert parsed["key_case"].eventType == "KEYSTROKE"
    for name in ("not_json", "array", "blank", "null"):
        assert all(parsed[name][f] is None for f in EVENT_SCHEMA.names)


def test_fast_path_keeps_the_same_keystrokes(decoded):
    slow = ev.keystrokes(ev.parse_events(decoded)).select("userId", "data.wpm", "data.accuracy")
    fast = ev.keystroke_events(decoded).select("userId", "data.wpm", "data.accuracy")
    assert sorted(slow.collect()) == sorted(fast.collect())
    assert {r.userId for r in fast.collect()} == {"ann", "7", "esc"}


def test_parse_runs_once(decoded):
    plan = ev.keystroke_events(decoded)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_unreadable(decoded):
    bad = ev.unreadable_events(decoded, keep=["name"]).collect()
    assert {r.name: r.reason for r in bad} == {
        "not_json": "malformed", "array": "malformed", "blank": "empty", "null": "empty"}


def test_encode_leaves_out_nulls_and_round_trips(spark, decoded):
    events = ev.parse_events(decoded.filter("name = 'full'"))
    encoded = ev.encode_events(events)
    row = encoded.first()
    assert row.key == "ann"
    wanted = {**FULL, "data": {k: v for k, v in FULL["data"].items() if k != "timeRemaining"}}
    assert json.loads(bytes(row.value)) == wanted
    assert ev.parse_events(ev.decode_values(encoded)).collect() == events.collect()


def test_enrich(spark):
    events = spark.createDataFrame([("KEYSTROKE", "a"), ("KEYSTROKE", "b")], "eventType string, userId string")
    rows = ev.enrich(events).collect()
    assert len({r.event_id for r in rows}) == 2
    assert all(len(r.event_id) == 36 and r.server_timestamp.endswith("Z") for r in rows)
    fixed = ev.enrich(events, ev.derived_id("eventType", "userId"), F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    assert {r.server_timestamp for r in fixed.collect()} == {"2024-01-01T00:00:00.000Z"}


def test_envelope_and_payload(spark):
    record = ev.envelope(
        F.to_timestamp(F.lit("2024-01-01 00:00:00.5")), F.lit("TEST_START"), F.lit("ann"),
        ev.payload(quote=F.lit("passage")),
    )
    text = spark.range(1).select(F.to_json(record)).first()[0]
    assert json.loads(text) == {
        "timestamp": "2024-01-01T00:00:00.500Z", "eventType": "TEST_START", "userId": "ann",
        "data": {"quote": "passage"}}
    assert list(json.loads(text)) == ["timestamp", "eventType", "userId", "data"]
    with pytest.raises(ValueError):
        ev.payload(speed=F.lit(1))


def test_user_guard_and_routing(spark):
    rows = spark.createDataFrame([("A", "x"), ("B", ""), ("A", None)], "eventType string, userId string")
    assert ev.with_non_empty_user(rows).count() == 1
    assert ev.route(rows, "A").count() == 2
