"""Streams replayed in several micro-batches give what batch gives."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from keycadence.operators import ranking, serving
from keycadence.operators.sessions import (
    event_counter,
    session_changes,
    session_tracker,
    sessions_from_log,
)
from keycadence.plans import analytics
from keycadence.plans.sample import typing_events, typing_records
from keycadence.schema import EVENT_SCHEMA
from keycadence.sources.replay import read_lines, replay_lines, replay_parquet
from keycadence.sources.storage import read_last_batch, read_log, write_batch
from keycadence.streaming import counter, progress, service, sinks
from keycadence.streaming.health import query_health
from keycadence.streaming.sessions import (
    late_events,
    stream_sessions,
    stream_sessions_in_order,
)

from .conftest import SF_DIR

FILES = 6


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet")


@pytest.fixture(scope="module")
def log(spark, events, tmp_path_factory):
    """The events as six files, in event order by name and modification time."""
    folder = tmp_path_factory.mktemp("log")
    bounds = events.selectExpr(f"ntile({FILES}) OVER (ORDER BY ts) AS part", "*").persist()
    for part in range(1, FILES + 1):
        _add_file(bounds.filter(F.col("part") == part).drop("part"), folder, part)
    bounds.unpersist()
    return folder


def _add_file(rows, folder, part):
    work = f"{folder}-work{part}"
    rows.coalesce(1).write.mode("overwrite").parquet(work)
    (name,) = [n for n in os.listdir(work) if n.endswith(".parquet")]
    target = f"{folder}/part-{part:02d}.parquet"
    os.link(f"{work}/{name}", target)
    at = time.time() - 600 + part * 10
    os.utime(target, (at, at))


def _replay(spark, events, folder):
    stream = replay_parquet(spark, str(folder), events.schema, files_per_trigger=1)
    return typing_records(stream)


def _same(found, wanted):
    names = sorted(wanted.columns)
    assert sorted(found.columns) == names
    assert sorted(map(str, found.select(names).collect())) == sorted(
        map(str, wanted.select(names).collect()))


def _rounded(stats):
    return stats.withColumns(
        {c: F.round(c, 6) for c in ("avg_wpm", "avg_accuracy", "wpm_variance")})


def test_complete_results(spark, events, log, tmp_path):
    at = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    query = sinks.start_batches(
        analytics.stats_of(_replay(spark, events, log)),
        [
            sinks.snapshot_writer(f"{tmp_path}/results", lambda s: ranking.result_records(s, at)),
            sinks.leaderboard_writer(f"{tmp_path}/board"),
        ],
        f"{tmp_path}/checkpoint",
        sinks.ALL_AVAILABLE,
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] == FILES - 1
    wanted = analytics.results_of(typing_records(events), at)
    _same(spark.read.parquet(f"{tmp_path}/results"), wanted)
    _same(
        spark.read.parquet(f"{tmp_path}/board"),
        serving.leaderboard(serving.stored_results(wanted)),
    )
    health = query_health(query)
    assert not health["failed"] and health["state_rows"] > 0


def test_update_log_equals_batch(spark, events, log, tmp_path):
    analytics.start_stats_log(
        _replay(spark, events, log), str(tmp_path), sinks.ALL_AVAILABLE
    ).awaitTermination()
    written = read_log(spark, f"{tmp_path}/stats")
    assert written.select("batch_id").distinct().count() == FILES
    found = analytics.current_stats(written)
    _same(_rounded(found), _rounded(analytics.stats_of(typing_records(events))))


def test_restart_continues_from_the_checkpoint(spark, events, log, tmp_path):
    grown = tmp_path / "grown"
    grown.mkdir()

    def run():
        sinks.start_batches(
            analytics.stats_of(_replay(spark, events, grown)),
            [sinks.snapshot_writer(f"{tmp_path}/stats")],
            f"{tmp_path}/checkpoint",
            sinks.ALL_AVAILABLE,
        ).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/stats")

    names = sorted(os.listdir(log))
    names = [n for n in names if n.endswith(".parquet")]
    for name in names[:2]:
        os.link(log / name, grown / name)
    first = {r.userId for r in run().collect()}
    for name in names[2:]:
        os.link(log / name, grown / name)
    wanted = analytics.stats_of(typing_records(events))
    _same(_rounded(run()), _rounded(wanted))
    assert len(first) < wanted.count()


def test_failed_batch_runs_again(spark, events, log, tmp_path):
    fail = [True]

    def once_broken(batch, batch_id):
        if batch_id == 2 and fail:
            fail.clear()
            raise RuntimeError("writer down")
        write_batch(batch, f"{tmp_path}/log", batch_id)

    def run():
        return sinks.start_batches(
            analytics.stats_of(_replay(spark, events, log)), [once_broken],
            f"{tmp_path}/checkpoint", sinks.ALL_AVAILABLE, mode="update")

    query = run()
    with pytest.raises(Exception, match="writer down"):
        query.awaitTermination()
    assert query_health(query)["failed"]
    run().awaitTermination()
    found = analytics.current_stats(read_log(spark, f"{tmp_path}/log"))
    _same(_rounded(found), _rounded(analytics.stats_of(typing_records(events))))


@pytest.mark.parametrize("timeout", [None, 86_400])
def test_sessions(spark, events, log, tmp_path, timeout):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(timeout is None).lower())
    sinks.start_batches(
        stream_sessions(analytics.session_marks(_replay(spark, events, log)), timeout),
        [sinks.log_writer(f"{tmp_path}/sessions")],
        f"{tmp_path}/checkpoint",
        sinks.ALL_AVAILABLE,
        mode="update",
    ).awaitTermination()
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    written = read_log(spark, f"{tmp_path}/sessions")
    assert written.select("batch_id").distinct().count() == FILES
    found = serving.latest_per_key(written, "userId", ["batch_id"]).drop("batch_id")
    _same(found, session_tracker(analytics.session_marks(typing_records(events))))


@pytest.mark.parametrize("floor", [10_000_000, 4])
def test_session_log(spark, events, log, tmp_path, floor):
    sinks.start_batches(
        analytics.session_marks(_replay(spark, events, log)),
        [sinks.log_writer(f"{tmp_path}/log", lambda marks: session_changes(marks, floor=floor))],
        f"{tmp_path}/checkpoint",
        sinks.ALL_AVAILABLE,
        mode="append",
    ).awaitTermination()
    found = sessions_from_log(read_log(spark, f"{tmp_path}/log"))
    _same(found, session_tracker(analytics.session_marks(typing_records(events))))


def test_service_store(spark, events, log, tmp_path, capsys):
    """Six batches kept as changes give what one aggregate over all events gives."""
    queries = analytics.start_service(_replay(spark, events, log), str(tmp_path), sinks.ALL_AVAILABLE)
    for query in queries:
        query.awaitTermination()
    assert {query_health(query)["state"] for query in queries} == {"ended"}
    folder, store = str(tmp_path), service.user_store(spark, str(tmp_path))
    assert store.versions()[-1] == FILES - 1
    whole = analytics.stats_of(typing_records(events)).drop("performance_level")
    _same(_rounded(service.read_stats(spark, folder)), _rounded(whole))
    at = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    results = ranking.result_records(whole, at)
    _same(service.read_results(spark, folder, at), results)
    stored = serving.stored_results(results, at)
    _same(service.read_leaderboard(spark, folder), serving.leaderboard(stored))
    users = stored.select("userId").limit(40).unionByName(
        spark.createDataFrame([("nobody",)], "userId string"))
    users = spark.createDataFrame(users.collect(), users.schema)
    _same(service.lookup_stored(spark, folder, users, at), serving.lookup_with_default(users, stored))
    _same(service.lookup_stored(spark, folder, users, at, with_default=False),
          serving.lookup_present(users, stored))
    assert service.read_result_json(spark, folder).count() == whole.count()
    population = service.read_population(spark, folder)
    wanted = ranking.population_stats(whole).first()
    assert population.users == wanted.users
    assert population.mean == pytest.approx(wanted.population_mean, abs=1e-9)
    assert population.spread == pytest.approx(wanted.population_stddev, abs=1e-9)
    assert "batch 0" in capsys.readouterr().out
    # one query, one read of the source, no state of Spark's own
    assert len(queries) == 1 and len(queries[0].lastProgress["sources"]) == 1
    assert not queries[0].lastProgress["stateOperators"]


def test_service_after_a_failure(spark, events, log, tmp_path):
    """A batch that was stored before it failed runs again and counts once."""
    fail = [True]

    def once_broken(batch, batch_id):
        if batch_id == 3 and fail:
            fail.clear()
            raise RuntimeError("writer down")

    def run():
        return service.start_service(
            _replay(spark, events, log), str(tmp_path), sinks.ALL_AVAILABLE, once_broken, bucket_rows=50)

    with pytest.raises(Exception, match="writer down"):
        run().awaitTermination()
    assert service.user_store(spark, str(tmp_path)).versions()[-1] == 3
    run().awaitTermination()
    whole = analytics.stats_of(typing_records(events)).drop("performance_level")
    _same(_rounded(service.read_stats(spark, str(tmp_path))), _rounded(whole))


def test_batches_without_keystrokes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"eventType": "TEST_START", "userId": "a"}\n')
    service.start_service(
        replay_lines(spark, f"{tmp_path}/in", 1), f"{tmp_path}/out", sinks.ALL_AVAILABLE
    ).awaitTermination()
    assert service.read_population(spark, f"{tmp_path}/out").users == 0
    assert service.read_leaderboard(spark, f"{tmp_path}/out").count() == 0
    with pytest.raises(LookupError):
        service.read_stats(spark, f"{tmp_path}/out")


@pytest.mark.parametrize("floor", [10_000_000, 4])
def test_event_counter_over_batches(spark, events, log, tmp_path, floor):
    """Stopped after two files and started again; also with users in slices."""
    grown = tmp_path / "grown"
    grown.mkdir()
    names = sorted(n for n in os.listdir(log) if n.endswith(".parquet"))
    for part in (names[:2], names[2:]):
        for name in part:
            os.link(log / name, grown / name)
        counter.start_event_counter(
            analytics.session_marks(_replay(spark, events, grown)), f"{tmp_path}/out",
            sinks.ALL_AVAILABLE, floor=floor,
        ).awaitTermination()
    found = counter.read_counted(spark, f"{tmp_path}/out")
    _same(found, event_counter(analytics.session_marks(typing_records(events))))


def _line(kind, user, minute, n):
    at = f"2024-01-01T{10 + minute // 60}:{minute % 60:02d}:00.000Z"
    return json.dumps({"eventType": kind, "userId": user, "timestamp": at, "event_id": f"e{n}"})


def test_sessions_in_order(spark, tmp_path):
    """Shuffled within the delay, and one event that is later than that."""
    files = [
        [("SESSION_START", "a", 10, 1), ("KEYSTROKE", "a", 30, 2), ("KEYSTROKE", "b", 5, 3)],
        [("TEST_COMPLETE", "a", 20, 4), ("SESSION_START", "a", 12, 5), ("SESSION_START", "b", 4, 6)],
        [("KEYSTROKE", "c", 200, 7)],
        [("KEYSTROKE", "a", 11, 8), ("KEYSTROKE", "a", 210, 9), ("SESSION_START", "c", 190, 10)],
        [("KEYSTROKE", "a", 215, 11), ("TEST_COMPLETE", "c", 201, 12), ("KEYSTROKE", "a", 25, 13)],
    ]
    (tmp_path / "in").mkdir()
    for number, lines in enumerate(files):
        path = tmp_path / "in" / f"{number}.json"
        path.write_text("\n".join(_line(*line) for line in lines) + "\n")
        os.utime(path, (time.time() - 600 + number * 10,) * 2)
    marks = analytics.session_marks(replay_lines(spark, f"{tmp_path}/in", 1))
    query = sinks.start_batches(
        stream_sessions_in_order(marks, "30 minutes"), [sinks.log_writer(f"{tmp_path}/log")],
        f"{tmp_path}/checkpoint", sinks.ALL_AVAILABLE, mode="update")
    query.awaitTermination()
    newest = serving.latest_per_key(read_log(spark, f"{tmp_path}/log"), "userId", ["batch_id"])
    found = {
        r.userId: (r.start_time.strftime("%H:%M"), r.end_time and r.end_time.strftime("%H:%M"), r.events_count)
        for r in newest.collect()
    }
    assert found == {
        "a": ("10:12", "10:20", 5), "b": ("10:04", None, 2), "c": ("13:10", "13:21", 3)}
    assert late_events(query) == 1


def test_progress_outlives_its_query(spark, events, log, tmp_path):
    spark.streams.resetTerminated()
    listener = progress.log_progress(spark, str(tmp_path), lines=2)
    try:
        service.start_service(_replay(spark, events, log), f"{tmp_path}/out", sinks.ALL_AVAILABLE).awaitTermination()

        def broken(batch, batch_id):
            raise RuntimeError("writer down")

        with pytest.raises(Exception, match="writer down"):
            sinks.start_batches(
                analytics.session_marks(_replay(spark, events, log)), [broken],
                f"{tmp_path}/checkpoint", sinks.ALL_AVAILABLE, mode="append").awaitTermination()
        for _ in range(100):
            reports = progress.read_progress(spark, str(tmp_path))
            if reports.filter("kind = 'end'").count() == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
        spark.streams.resetTerminated()
    runs = {r.state: r for r in progress.runs(reports).collect()}
    assert set(runs) == {"ended", "failed"} and "writer down" in runs["failed"].error
    assert runs["ended"].input_rows == events.count() and runs["ended"].last_batch == FILES - 1
    health = progress.logged_health(reports).first()
    assert (health.status, health.queries, health.open, health.failed) == ("failing", 2, 0, 1)
    # a start without an end is lost, or was started again
    starts = reports.filter("kind = 'start'")
    assert {r.state for r in progress.runs(starts).collect()} == {"open"}
    twice = starts.unionByName(starts.withColumns({"run": F.lit("x"), "at": F.lit("9")}))
    assert sorted(r.state for r in progress.runs(twice).collect()) == ["open", "open", "restarted", "restarted"]


def test_service_logs_unreadable_records(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"eventType": "TEST_START", "userId": "a"}\nnot json\n')
    records = replay_lines(spark, f"{tmp_path}/in", 1)
    for query in analytics.start_service(records, f"{tmp_path}/out", sinks.ALL_AVAILABLE):
        query.awaitTermination()
    bad = read_log(spark, f"{tmp_path}/out/unreadable")
    assert [(r.json, r.reason) for r in bad.collect()] == [("not json", "malformed")]


def test_processing_time_trigger_and_await(spark, events, log, tmp_path):
    # Forget queries of other tests, failed on purpose: awaiting would raise theirs.
    spark.streams.resetTerminated()
    query = sinks.start_batches(
        analytics.stats_of(_replay(spark, events, log)),
        [sinks.snapshot_writer(f"{tmp_path}/stats")],
        f"{tmp_path}/checkpoint",
        sinks.every(1),
    )
    try:
        query.processAllAvailable()
        assert query_health(query)["active"]
    finally:
        query.stop()
    sinks.await_any(spark)
    spark.streams.resetTerminated()


def test_empty_batches_are_not_written(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"eventType": "TEST_START", "userId": "a"}\nnot json\n')
    sinks.start_batches(
        analytics.stats_of(replay_lines(spark, f"{tmp_path}/in", 1)),
        [sinks.snapshot_writer(f"{tmp_path}/stats")],
        f"{tmp_path}/checkpoint",
        sinks.ALL_AVAILABLE,
    ).awaitTermination()
    assert not (tmp_path / "stats").exists()


def test_text_log_equals_bytes(spark, events, tmp_path):
    lines = typing_records(events).select(F.col("value").cast("string").alias("value"))
    lines.write.text(f"{tmp_path}/log")
    at = F.to_timestamp(F.lit("2024-06-01 00:00:00"))
    _same(
        analytics.results_of(read_lines(spark, f"{tmp_path}/log"), at),
        analytics.results_of(typing_records(events), at),
    )


def test_batch_log_is_repeatable(spark, tmp_path):
    folder = f"{tmp_path}/log"
    for batch_id, size in ((0, 3), (1, 4), (1, 5)):
        write_batch(spark.range(size), folder, batch_id)
    assert read_log(spark, folder).count() == 8
    assert read_last_batch(spark, folder).count() == 5


def test_sample_has_the_event_schema(spark, events):
    names = typing_events(events).columns
    assert set(names) == set(EVENT_SCHEMA.names) - {"server_timestamp"}
