"""The session tracker as a stateful stream."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schema import SESSION_START, TEST_COMPLETE

# The state function travels to the executors as code, so that a cluster without
# this package installed can run it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Stands for a missing time in the state, and comes before all others.
_NO_TIME = -(1 << 62)

#: Users are hashed into so many groups. A group is one state row and one call of the
#: state function, which works on all of its users at once by arrays; a call for each
#: user costs milliseconds and more than all else. Fixed by a stream's first start.
GROUPS = 1024

_KINDS = [SESSION_START, TEST_COMPLETE]
_SESSIONS = pa.schema([
    ("userId", pa.string()), ("start_us", pa.int64()), ("end_us", pa.int64()),
    ("events_count", pa.int64()), ("seen_ms", pa.int64()),
])
_WAITING = pa.schema([
    ("userId", pa.string()), ("at_us", pa.int64()), ("event_id", pa.string()), ("kind", pa.int8()),
])
_OUTPUT = "userId string, start_us long, end_us long, events_count long"

_Rows = dict[str, np.ndarray]


def _packed(rows: _Rows, schema: pa.Schema) -> bytes:
    """Columns as the bytes that stand in the state."""
    arrays = [pa.array(rows[f.name], f.type, from_pandas=True) for f in schema]
    return pa.record_batch(arrays, schema=schema).serialize().to_pybytes()


def _unpacked(data: bytes | None, schema: pa.Schema) -> _Rows:
    if data is None:
        return {f.name: np.zeros(0, object if f.type == pa.string() else f.type.to_pandas_dtype()) for f in schema}
    batch = pa.ipc.read_record_batch(pa.py_buffer(bytes(data)), schema)
    return {f.name: batch.column(f.name).to_numpy(zero_copy_only=False) for f in schema}


def _joined(parts: list[_Rows], schema: pa.Schema) -> _Rows:
    return {name: np.concatenate([part[name] for part in parts]) for name in schema.names}


def _picked(rows: _Rows, which: np.ndarray) -> _Rows:
    return {name: values[which] for name, values in rows.items()}


def _events(part: pd.DataFrame) -> _Rows:
    """Columns of ``_WAITING`` out of a part of a micro-batch."""
    kinds = part["eventType"].to_numpy(object)
    kind = np.full(len(part), len(_KINDS), np.int8)
    for code, name in enumerate(_KINDS):
        kind[kinds == name] = code
    return {
        "userId": part["userId"].to_numpy(object),
        "at_us": part["at_us"].fillna(_NO_TIME).to_numpy("int64"),
        "event_id": part["event_id"].to_numpy(object),
        "kind": kind,
    }


def _order(user: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places in the order of user, time and event id, without an id first."""
    order = np.lexsort((at, user))
    same = (np.diff(user[order]) == 0) & (np.diff(at[order]) == 0)
    if not same.any():
        return order
    tied = order[np.append(same, False) | np.append(False, same)]
    rank = np.zeros(len(at), np.int64)
    rank[tied] = pd.factorize(ids[tied], sort=True)[0]
    return np.lexsort((rank, at, user))


def _advance(sessions: _Rows, events: _Rows, now: int = 0) -> tuple[_Rows, np.ndarray]:
    """Sessions after some events, each user's in event order, and which of them had any."""
    known = len(sessions["userId"])
    codes, users = pd.factorize(np.concatenate([sessions["userId"], events["userId"]]))
    user = codes[known:]
    order = _order(user, events["at_us"], events["event_id"])
    user, at, kind = user[order], events["at_us"][order], events["kind"][order]
    begins = np.flatnonzero(np.diff(user, prepend=-1))
    sizes = np.diff(np.append(begins, len(user)))
    place = np.arange(len(user))

    def last(wanted: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(np.where(wanted, place, -1), begins) if len(begins) else begins

    start = last(kind == 0)
    started = start >= 0
    first = np.where(started, start, begins)
    end = last((kind == 1) & (at != _NO_TIME) & (place >= np.repeat(first, sizes)))

    more = np.zeros(len(users) - known, np.int64)
    after = {name: np.concatenate([sessions[name], more]) for name in _SESSIONS.names[1:]}
    after["userId"] = np.asarray(users, object)
    opened = np.arange(len(users)) < known
    touched = np.zeros(len(users), bool)
    who = user[begins]
    before_end = np.where(started, _NO_TIME, after["end_us"][who])
    after["start_us"][who] = np.where(started, at[first], after["start_us"][who])
    after["end_us"][who] = np.where(end >= 0, at[end], before_end)
    counted = np.where(started, 0, after["events_count"][who])
    after["events_count"][who] = counted + begins + sizes - first
    after["seen_ms"][who] = now
    opened[who] |= started
    touched[who] = True
    return _picked(after, opened), touched[opened]


def _shown(sessions: _Rows, which: np.ndarray) -> pd.DataFrame:
    names = ["userId", "start_us", "end_us", "events_count"]
    return pd.DataFrame({name: sessions[name][which] for name in names})


def _group(groups: int) -> Column:
    return F.pmod(F.xxhash64("userId"), F.lit(groups)).cast("int").alias("group")


def _time(micros: str) -> Column:
    return F.timestamp_micros(F.nullif(F.col(micros), F.lit(_NO_TIME)))


def stream_sessions(
    events: DataFrame, timeout_seconds: int | None = None, groups: int = GROUPS
) -> DataFrame:
    """Streaming form of ``session_tracker``; use with update output mode.

    One small session per user, kept in a state row for each of ``groups`` groups of
    users. Sessions never expire unless ``timeout_seconds`` is given; then those idle
    for longer are dropped. (Spark then runs batches without data for ever: a run that
    is to end with its input also needs
    ``spark.sql.streaming.noDataMicroBatches.enabled=false``.)
    A micro-batch holds a group's events in one task, so the source's rate limit
    bounds them. Events are put in order within a micro-batch; across
    micro-batches the order of arrival counts.
    """
    idle = (timeout_seconds or 0) * 1000

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        sessions = _unpacked(state.get[0] if state.exists else None, _SESSIONS)
        touched = np.zeros(len(sessions["userId"]), bool)
        now = state.getCurrentProcessingTimeMs()
        if not state.hasTimedOut:
            fresh = _joined([_events(part) for part in batches], _WAITING)
            sessions, touched = _advance(sessions, fresh, now)
        if idle:
            kept = touched | (sessions["seen_ms"] + idle > now)
            sessions, touched = _picked(sessions, kept), touched[kept]
        if not len(touched):
            if state.exists:
                state.remove()
            return
        state.update((_packed(sessions, _SESSIONS),))
        if idle:
            state.setTimeoutDuration(max(1, int(sessions["seen_ms"].min()) + idle - now))
        if touched.any():
            yield _shown(sessions, touched)

    marks = events.filter(F.col("userId").isNotNull()).select(
        "userId", "eventType", "event_id", F.unix_micros("event_ts").alias("at_us"), _group(groups)
    )
    kinds = GroupStateTimeout
    wait = kinds.ProcessingTimeTimeout if timeout_seconds else kinds.NoTimeout
    tracked = marks.groupBy("group").applyInPandasWithState(
        step, _OUTPUT, "sessions binary", "update", wait
    )
    return tracked.select(
        "userId",
        _time("start_us").alias("start_time"),
        _time("end_us").alias("end_time"),
        "events_count",
    )


# Event order across micro-batches


def stream_sessions_in_order(
    events: DataFrame, delay: str = "10 minutes", groups: int = GROUPS
) -> DataFrame:
    """Sessions by event time, also where events arrive out of order; update mode.

    A user's events wait until the watermark, ``delay`` behind the newest event of the
    stream, has passed them; then they are taken into the session in order. A row shows
    the session with the waiting events on top, so it is up to date at once and, as long
    as no event is later than ``delay``, what the batch tracker gives for all events so
    far. Later ones change nothing and are counted by ``late_events``.

    State holds one session per user and the events of the last ``delay``, in a row for
    each of ``groups`` groups of users. A timer at the oldest waiting event of a group
    takes them in even if its users send no more. Events without a time cannot be placed
    and take no part.
    """

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        known = state.get if state.exists else (None, None)
        sessions, waiting = _unpacked(known[0], _SESSIONS), _unpacked(known[1], _WAITING)
        senders = None
        if not state.hasTimedOut:
            fresh = _joined([_events(part) for part in batches], _WAITING)
            senders = pd.unique(fresh["userId"])
            waiting = _joined([waiting, fresh], _WAITING)
        past = waiting["at_us"] < state.getCurrentWatermarkMs() * 1000
        if past.any():
            sessions, _ = _advance(sessions, _picked(waiting, past))
            waiting = _picked(waiting, ~past)
        state.update((_packed(sessions, _SESSIONS), _packed(waiting, _WAITING)))
        if len(waiting["at_us"]):
            due = int(waiting["at_us"].min()) // 1000 + 1
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if senders is not None:
            sent = lambda rows: _picked(rows, pd.Series(rows["userId"]).isin(senders).to_numpy())
            shown, _ = _advance(sent(sessions), sent(waiting))
            if len(shown["userId"]):
                yield _shown(shown, np.ones(len(shown["userId"]), bool))

    marks = (
        events.filter(F.col("userId").isNotNull() & F.col("event_ts").isNotNull())
        .withWatermark("event_ts", delay)
        .select(
            "userId", "eventType", "event_id", "event_ts",
            F.unix_micros("event_ts").alias("at_us"), _group(groups),
        )
    )
    tracked = marks.groupBy("group").applyInPandasWithState(
        step, _OUTPUT, "sessions binary, waiting binary", "update", GroupStateTimeout.EventTimeTimeout
    )
    return tracked.select(
        "userId",
        _time("start_us").alias("start_time"),
        _time("end_us").alias("end_time"),
        "events_count",
    )


def late_events(query: StreamingQuery) -> int:
    """Events a query has left out since its start because they came too late."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
