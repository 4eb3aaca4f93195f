"""What may not grow with the tables: files of a change, calls of a state function, one reading task."""

import random

import numpy as np
from pyspark.sql import functions as F

from keycadence.operators import serving
from keycadence.operators.sessions import session_tracker
from keycadence.plans import analytics
from keycadence.plans.sample import typing_records
from keycadence.sources.files import Files
from keycadence.sources.keyed_store import SMALL_BUCKETS, KeyedStore
from keycadence.sources.replay import replay_parquet, write_in_parts
from keycadence.sources.storage import read_log
from keycadence.streaming import sessions, sinks

from .conftest import SMALL_DIR


def test_a_part_of_a_replay_is_several_files(spark, tmp_path):
    """Each micro-batch is one range of the order, also where a range has too few rows."""
    rows = spark.range(700).select("id", F.when(F.col("id") % 50 > 0, F.col("id") % 7).alias("at"))
    folder = write_in_parts(rows, "at", 6, f"{tmp_path}/replay", files=5)
    names = [n for n in Files(spark, folder).names() if n.startswith("part-")]
    assert len(names) % 5 == 0 and len(names) >= 20
    seen = []
    batches = lambda batch, _: seen.append(
        batch.agg(F.count("*"), F.min("at"), F.max("at"), F.count_if(F.isnull("at"))).first())
    stream = replay_parquet(spark, folder, rows.schema, files_per_trigger=5)
    sinks.start_batches(stream, [batches], f"{tmp_path}/check", sinks.ALL_AVAILABLE, "append").awaitTermination()
    assert sum(n for n, *_ in seen) == 700 and [x[3] for x in seen] == [14] + [0] * (len(seen) - 1)
    assert all(before[2] < after[1] for before, after in zip(seen, seen[1:]))


def test_small_buckets_are_few(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/store", bucket_rows=2)
    frame = spark.range(3000).selectExpr("concat('u', id) AS userId", "id AS value", "0L AS version")
    run = store.write_run(frame, 0, 3000)
    store.commit(0, None, run, frame.schema, {})
    assert run.buckets == SMALL_BUCKETS and run.rows == 3000
    assert len(store.files.names(run.path)) <= SMALL_BUCKETS + 1  # and the mark of success
    asked = spark.createDataFrame([("u7",), ("x",)], "userId string")
    assert [(r.userId, r.value) for r in store.lookup(asked).collect()] == [("u7", 7)]
    assert store.rows().agg(F.sum("value")).first()[0] == 3000 * 2999 // 2


def _one_by_one(known, events):
    """Sessions event by event."""
    out = dict(known)
    for user, at, _, kind in sorted(events, key=lambda e: (e[1] is not None, e[1] or 0, e[2] is not None, e[2] or "")):
        at = sessions._NO_TIME if at is None else at
        if kind == 0:
            out[user] = (at, sessions._NO_TIME, 0)
        if user in out:
            start, end, n = out[user]
            out[user] = (start, at if kind == 1 and at != sessions._NO_TIME else end, n + 1)
    return out


def test_all_users_of_a_group_at_once():
    rng = random.Random(3)
    rows, known = sessions._unpacked(None, sessions._SESSIONS), {}
    for size in (0, 40, 1, 200, 90):
        events = [
            (f"u{rng.randint(0, 12)}", rng.choice([None, *range(9)]), rng.choice([None, *"abcdefgh"]), rng.randint(0, 2))
            for _ in range(size)
        ]
        # equal time and id would leave the order open
        events = list({e[:3]: e for e in events}.values())
        known = _one_by_one(known, events)
        user, at, ids, kind = zip(*events) if events else ((), (), (), ())
        fresh = {
            "userId": np.array(user, object), "event_id": np.array(ids, object), "kind": np.array(kind, np.int8),
            "at_us": np.array([sessions._NO_TIME if x is None else x for x in at], np.int64),
        }
        rows, touched = sessions._advance(rows, fresh)
        assert set(rows["userId"][touched]) == {u for u in user if u in known}
        rows = sessions._unpacked(sessions._packed(rows, sessions._SESSIONS), sessions._SESSIONS)
        names = ["userId", "start_us", "end_us", "events_count"]
        assert {u: tuple(x) for u, *x in zip(*(rows[n].tolist() for n in names))} == known


def test_state_rows_do_not_follow_the_users(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL_DIR}/events.parquet")
    folder = write_in_parts(events, "ts", 3, f"{tmp_path}/replay")
    wanted = session_tracker(analytics.session_marks(typing_records(events)))
    for stream in (sessions.stream_sessions, sessions.stream_sessions_in_order):
        marks = analytics.session_marks(typing_records(replay_parquet(spark, folder, events.schema, 1)))
        out = f"{tmp_path}/{stream.__name__}"
        query = sinks.start_batches(
            stream(marks, groups=5), [sinks.log_writer(f"{out}/log")], f"{out}/check",
            sinks.ALL_AVAILABLE, mode="update")
        query.awaitTermination()
        assert sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]) == 5
        found = serving.latest_per_key(read_log(spark, f"{out}/log"), "userId", ["batch_id"])
        found = found.select(wanted.columns)
        assert found.exceptAll(wanted).count() == 0 == wanted.exceptAll(found).count()
