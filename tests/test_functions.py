"""Column expressions against plain Python."""

import math

import pytest
import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from keycadence.functions import labels, numbers, scoring, times
from keycadence.operators import texts


def _values(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def test_tenths_is_python_round(spark):
    rng = random.Random(7)
    values = [0.0, 0.04, 0.05, 0.25, 0.35, 20.15, 20.25, 99.95, 0.03, 1e9 + 0.25, 123456.75]
    values += [n / 20 for n in range(1, 4001)]
    values += [rng.uniform(0, 300) for _ in range(2000)]
    values += [rng.randint(0, 20000) / rng.randint(1, 400) for _ in range(4000)]
    values += [-v for v in values[:50]]
    values.append(None)
    rows = _values(spark, values).select("i", numbers.tenths(F.col("v")).alias("r")).collect()
    found = {r.i: r.r for r in rows}
    for i, value in enumerate(values):
        assert found[i] == (None if value is None else round(value, 1)), value


def test_half_up(spark):
    values = [0.0, 0.4, 0.5, 1.5, 2.5, 99.49, 99.5, None]
    rows = _values(spark, values).select("i", numbers.half_up(F.col("v")).alias("r")).collect()
    for r in rows:
        value = values[r.i]
        assert r.r == (None if value is None else math.floor(value + 0.5))


def test_or_default(spark):
    rows = _values(spark, [None, 0.0, 3.0]).select("i", numbers.or_default(F.col("v"), 10.0).alias("r"))
    assert {r.i: r.r for r in rows.collect()} == {0: 10.0, 1: 10.0, 2: 3.0}


def test_times(spark):
    at = "2024-03-01T12:00:01.250Z"
    row = (
        spark.createDataFrame([(at,)], "t string")
        .select(times.event_time(F.col("t")).alias("ts"))
        .select(
            times.iso_utc(F.col("ts")).alias("iso"),
            times.epoch_millis(F.col("ts")).alias("ms"),
            times.iso_utc(times.from_epoch_millis(times.epoch_millis(F.col("ts")))).alias("back"),
        )
        .first()
    )
    wanted = datetime(2024, 3, 1, 12, 0, 1, 250000, tzinfo=timezone.utc).timestamp() * 1000
    assert (row.iso, row.ms, row.back) == (at, wanted, at)
    bad = spark.createDataFrame([("soon",), (None,)], "t string")
    assert all(r[0] is None for r in bad.select(times.event_time(F.col("t"))).collect())


def test_countdown(spark):
    rows = _values(spark, [0, 59, 60, 75], "int").select(
        "i", times.remaining_seconds(F.col("v")).alias("left")
    )
    assert {r.i: r.left for r in rows.collect()} == {0: 60, 1: 1, 2: 0, 3: 0}


def test_labels_at_the_bounds(spark):
    values = [60.0, 59.9, 50.0, 49.9, 40.0, 39.9, 30.0, 29.9, 20.0, 19.9, 0.0]
    rows = _values(spark, values).select(
        "i",
        labels.performance_level(F.col("v")).alias("level"),
        labels.performance_trend(F.col("v")).alias("trend"),
    )
    level = {60.0: "🏆 EXPERT", 40.0: "👍 INTERMEDIATE", 20.0: "📚 BEGINNER", -1.0: "🎯 PRACTICE NEEDED"}
    trend = {50.0: "🚀 FAST TYPIST", 30.0: "👍 MODERATE", -1.0: "📚 LEARNING"}
    for r in rows.collect():
        value = values[r.i]
        assert r.level == level[max(b for b in level if b <= value)]
        assert r.trend == trend[max(b for b in trend if b <= value)]


PASSAGE = "Kafka and Spark, ça va? 🎹 end"
ATTEMPTS = [
    ("", PASSAGE, 0),
    ("", "", 3),
    ("x", "", 3),
    (PASSAGE, PASSAGE, 59),
    (PASSAGE, PASSAGE, 60),
    (PASSAGE[:7], PASSAGE, 2),
    (PASSAGE + " and more", PASSAGE, 17),
    (PASSAGE.replace("a", "e"), PASSAGE, 1),
    (PASSAGE[1:], PASSAGE, 0),
    ("K\tf\n", PASSAGE, 61),
]


def _attempts(spark):
    rows = [(i, t, q, e) for i, (t, q, e) in enumerate(ATTEMPTS)]
    return spark.createDataFrame(rows, "id int, typed string, quote string, elapsed int")


def test_score_text_is_brute_force(spark):
    for r in texts.score_text(_attempts(spark), ["id"]).collect():
        typed, quote, elapsed = ATTEMPTS[r.id]
        correct = sum(a == b for a, b in zip(typed, quote))
        total = len(typed)
        accuracy = math.floor(correct / total * 100 + 0.5) if total else 100
        wpm = math.floor((total / 5) / (elapsed / 60) + 0.5) if elapsed else 0
        assert (r.correct, r.total, r.accuracy, r.wpm) == (correct, total, accuracy, wpm)
        assert 0 <= r.accuracy <= 100 and r.correct <= min(len(typed), len(quote))


def test_char_status_is_brute_force(spark):
    found = {
        (r.id, r.pos): (r.expected, r.status)
        for r in texts.char_status(_attempts(spark), ["id"]).collect()
    }
    wanted = {}
    for i, (typed, quote, _) in enumerate(ATTEMPTS):
        for pos, char in enumerate(quote):
            if pos >= len(typed):
                status = scoring.PENDING
            else:
                status = scoring.CORRECT if typed[pos] == char else scoring.INCORRECT
            wanted[i, pos] = (char, status)
    assert found == wanted


def _units(text):
    data = text.encode("utf-16-be")
    return [data[k : k + 2] for k in range(0, len(data), 2)]


EMOJI = [
    ("", "a😀b", 9), ("a😀b", "a😀b", 30), ("a😁b", "a😀b", 30), ("😀😀", "a😀😀", 7),
    ("x😀", "", 3), ("ab", "😀", 60), ("é𝄞", "é𝄞𝄞", 12), (PASSAGE, PASSAGE, 20),
]


def test_score_text_by_utf16_units(spark):
    """As a browser counts: the emoji of row 2 share their first unit."""
    rows = [(i, *row) for i, row in enumerate(EMOJI)]
    frame = spark.createDataFrame(rows, "id int, typed string, quote string, elapsed int")
    found = {r.id: (r.correct, r.total) for r in texts.score_text(frame, ["id"], utf16=True).collect()}
    for i, (typed, quote, _) in enumerate(EMOJI):
        t, q = _units(typed), _units(quote)
        assert found[i] == (sum(a == b for a, b in zip(t, q)), len(t))
    assert found[2] == (3, 4)
    points = {r.id: (r.correct, r.total) for r in texts.score_text(frame, ["id"]).collect()}
    assert points[2] == (2, 3)


@pytest.mark.parametrize("utf16", [False, True])
def test_status_runs_expand_to_char_status(spark, utf16):
    cases = ATTEMPTS + EMOJI
    rows = [(i, *row) for i, row in enumerate(cases)] + [(98, None, "ab", 1), (99, "a", None, 1)]
    frame = spark.createDataFrame(rows, "id int, typed string, quote string, elapsed int")
    found, last = {}, {}
    for r in texts.char_status_runs(frame, ["id"], utf16).orderBy("id", "start").collect():
        assert r.length > 0 and last.get(r.id) != r.status, "neighbours differ"
        last[r.id] = r.status
        found |= {(r.id, r.start + k): r.status for k in range(r.length)}
    split = _units if utf16 else list
    wanted = {(98, 0): scoring.PENDING, (98, 1): scoring.PENDING}
    for i, (typed, quote, _) in enumerate(cases):
        typed = split(typed)
        for pos, char in enumerate(split(quote)):
            right = pos < len(typed) and typed[pos] == char
            wanted[i, pos] = (
                scoring.PENDING if pos >= len(typed) else scoring.CORRECT if right else scoring.INCORRECT)
    assert found == wanted


def test_completion(spark):
    for r in texts.completion(_attempts(spark), ["id"]).collect():
        typed, quote, elapsed = ATTEMPTS[r.id]
        assert r.is_complete == (typed == quote and elapsed < 60)
        assert r.is_timed_out == (elapsed >= 60)
        assert r.remaining == max(60 - elapsed, 0)
        assert r.quote_length == len(quote)


def test_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame(
        [("2024-01-01T00:00:00.000Z",), ("1969-12-31T23:59:59.999Z",), ("2024-07-01T12:34:56.789+02:00",),
         ("2024-03-31T02:30:00.000",), (None,), ("nonsense",)], "t string")
    wanted = ["2024-01-01T00:00:00.000Z", "1969-12-31T23:59:59.999Z", "2024-07-01T10:34:56.789Z",
              "2024-03-31T02:30:00.000Z", None, None]
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            out = rows.select(times.iso_utc(times.event_time(F.col("t"))).alias("x")).collect()
            assert [r.x for r in out] == wanted, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tenths_passes_nan_and_infinity_through(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (-float("inf"),), (2.25,)], "x double")
    found = [r.y for r in rows.select(numbers.tenths(F.col("x")).alias("y")).collect()]
    assert str(found) == "[nan, inf, -inf, 2.2]"
