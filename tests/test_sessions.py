"""Session tracker and event counter against a plain loop, with a dominating user."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from keycadence.operators import sessions
from keycadence.operators.sessions import event_counter, session_tracker

KINDS = ["KEYSTROKE"] * 12 + ["TEST_START", "TEST_COMPLETE", "TEST_TIMEOUT", "SESSION_START", "TEST_RESTART"]
SCHEMA = "userId string, event_ts timestamp, event_id string, eventType string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _make(seed):
    """900 events: `big` has a third, half of them exact copies of one event; one user is null."""
    rng = random.Random(seed)
    rows = []
    for i in range(900):
        at = START + timedelta(milliseconds=rng.randrange(2000))
        if i % 3 == 0:
            user, copy = "big", i % 2 == 0
        else:
            user, copy = rng.choice(["a", "b", "c", "d", "late", None]), False
        if copy:
            rows.append((user, START + timedelta(seconds=1), "copy", "KEYSTROKE"))
        else:
            kind = "KEYSTROKE" if user == "late" and i < 800 else rng.choice(KINDS)
            rows.append((user, at, f"{rng.randrange(10**9):09d}", kind))
    rng.shuffle(rows)
    return rows


def _order(row):
    return row[1], row[2]


def _tracked(rows):
    sessions = {}
    for user, at, _, kind in sorted(rows, key=_order):
        if user is None:
            continue
        if kind == "SESSION_START":
            sessions[user] = [at, None, 0]
        if user in sessions:
            if kind == "TEST_COMPLETE":
                sessions[user][1] = at
            sessions[user][2] += 1
    return {u: tuple(s) for u, s in sessions.items()}


def _counted(rows):
    numbers, found = {}, []
    for user, at, event_id, kind in sorted(rows, key=_order):
        reset = kind in ("SESSION_START", "TEST_RESTART")
        numbers[user] = 1 if reset else numbers.get(user, 0) + 1
        found.append((str(user), at, event_id, kind, numbers[user]))
    return sorted(found)


def _utc(at):
    return at and at.astimezone(timezone.utc)


@pytest.fixture(params=[1, 2, 3])
def rows(request):
    return _make(request.param)


@pytest.mark.parametrize("floor", [10_000_000, 100, 7])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_session_tracker(spark, rows, floor, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
        found = {
            r.userId: (_utc(r.start_time), _utc(r.end_time), r.events_count)
            for r in session_tracker(frame, floor=floor).collect()
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == _tracked(rows)


@pytest.mark.parametrize("floor", [10_000_000, 100, 7])
def test_event_counter(spark, rows, floor):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = sorted(
        (str(r.userId), _utc(r.event_ts), r.event_id, r.eventType, r.event_no)
        for r in event_counter(frame, floor=floor).collect()
    )
    assert found == _counted(rows)


def test_heavy_users_are_cut_into_slices(spark):
    """The dominating user really spans several slices, copies of one event included."""
    frame = spark.createDataFrame(_make(5), SCHEMA).repartition(5).filter("userId = 'big'")
    sessions.ensure_checkpoint_dir(spark)
    counted = sessions._count_in_slices(frame, 4)
    sizes = [r["count"] for r in counted.groupBy("slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 200 and sum(sizes) == 300


def test_tracker_reads_the_events_twice_only(spark):
    """Profile, heavy users and their limit share one shuffle of the events."""
    frame = spark.createDataFrame(_make(4), SCHEMA)
    tracked = session_tracker(frame, floor=50)
    tracked.collect()
    plan = tracked._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 1
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
