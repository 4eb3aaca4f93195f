"""Named queries over the sample tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import epoch_millis, from_epoch_millis, iso_utc
from ..operators import events as ev
from ..operators import ranking, serving, sessions, texts
from ..operators.board import rankable
from ..operators.ranks import positions
from ..operators.stats import user_stats, with_performance_level
from ..session import use_utc
from ..sources.replay import files_for, replay_parquet, write_in_parts
from ..sources.storage import read_log, read_version, run_folder, write_version
from ..streaming import counter, service, sinks
from ..streaming.health import health
from ..streaming.sessions import stream_sessions
from ..streaming.sessions import stream_sessions_in_order as in_order
from .analytics import (
    current_stats,
    results_of,
    session_marks,
    session_users,
    start_session_log,
    start_stats_log,
    stats_of,
)
from .sample import typing_attempts, typing_events, typing_records

Query = Callable[[SparkSession, str], DataFrame]

#: Delivery time put on result records here, so that runs can be compared.
STAMP = "2024-06-01 00:00:00"


def _stamp() -> Column:
    return F.to_timestamp(F.lit(STAMP))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _records(spark, sf_dir):
    return typing_records(_table(spark, sf_dir, "events"))


def _decoded(spark, sf_dir):
    return ev.decode_values(_records(spark, sf_dir))


def _events(spark, sf_dir):
    return ev.parse_events(_decoded(spark, sf_dir))


def _stats(spark, sf_dir):
    return user_stats(ev.keystroke_events(_decoded(spark, sf_dir)))


def _results(spark, sf_dir):
    return results_of(_records(spark, sf_dir), _stamp())


def _stored(spark, sf_dir):
    return serving.stored_results(_results(spark, sf_dir), _stamp())


def _board(spark, sf_dir):
    return serving.leaderboard(_stored(spark, sf_dir))


def _marks(spark, sf_dir):
    return session_marks(_records(spark, sf_dir))


def _users(spark, sf_dir):
    return _marks(spark, sf_dir).select("userId").distinct()


def _requested(spark, sf_dir):
    """Every user but those whose name ends in 4, and a stranger for each that ends in 0."""
    users = _users(spark, sf_dir)
    strangers = users.filter(F.col("userId").endswith("0")).select(
        F.concat(F.lit("x"), F.col("userId")).alias("userId")
    )
    return users.filter(~F.col("userId").endswith("4")).unionByName(strangers)


def _attempts(spark, sf_dir):
    return typing_attempts(_table(spark, sf_dir, "documents"))


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    """Six decimals, to compare sums taken in another order."""
    return rows.withColumns({name: F.round(name, 6) for name in names})


def _shown_sessions(tracked: DataFrame) -> DataFrame:
    return tracked.select(
        "userId",
        iso_utc(F.col("start_time")).alias("start_time"),
        iso_utc(F.col("end_time")).alias("end_time"),
        "events_count",
    )


def _flat(events: DataFrame) -> DataFrame:
    payload = [c for c in events.schema["data"].dataType.names if c != "timestamp"]
    return events.select(
        *[c for c in events.columns if c not in ("data", "server_timestamp")],
        *[F.col(f"data.{c}").alias(c) for c in payload],
        F.col("data.timestamp").alias("data_timestamp"),
    )


# Events


def parse_events(spark, sf_dir):
    return _flat(_events(spark, sf_dir))


def keystrokes(spark, sf_dir):
    return ev.keystroke_events(_decoded(spark, sf_dir)).select(
        "userId", F.col("data.wpm").alias("wpm"), F.col("data.accuracy").alias("accuracy")
    )


def routed_events(spark, sf_dir):
    schema = ev.event_schema(("eventType", "userId", "timestamp"), ())
    return ev.events_of(
        _decoded(spark, sf_dir), ["SESSION_START", "TEST_COMPLETE"], schema
    ).select("eventType", "userId", "timestamp")


def encode_events(spark, sf_dir):
    encoded = ev.encode_events(_events(spark, sf_dir))
    return _flat(ev.parse_events(ev.decode_values(encoded, ["key"]), keep=["key"]))


def enrich_events(spark, sf_dir):
    timed = ev.with_event_time(_events(spark, sf_dir))
    stamped = ev.enrich(
        timed,
        event_id=ev.derived_id("eventType", "userId", "timestamp"),
        server_time=F.col("event_ts") + F.expr("INTERVAL 1 SECOND"),
    )
    return stamped.select("eventType", "userId", "event_id", "server_timestamp")


def event_times(spark, sf_dir):
    timed = ev.with_event_time(_events(spark, sf_dir))
    return timed.select(
        "event_id",
        epoch_millis(F.col("event_ts")).alias("event_millis"),
        iso_utc(from_epoch_millis(F.col("data.timestamp"))).alias("payload_time"),
    )


def test_outcomes(spark, sf_dir):
    fields = ev.event_schema(("eventType", "userId"), ("finalWPM", "finalAccuracy"))
    kinds = list(ev.OUTCOME_TYPES)
    return ev.test_outcomes(ev.events_of(_decoded(spark, sf_dir), kinds, fields))


def _broken(records: DataFrame) -> DataFrame:
    """Records in which users ending in 3 and 7 send broken ones."""
    last = F.substring("key", -1, 1)
    text = F.col("value").cast("string")
    broken = F.when(last == "3", F.concat(F.lit("x"), text)).when(last == "7", "").otherwise(text)
    return records.select("key", broken.cast("binary").alias("value"))


def malformed_events(spark, sf_dir):
    """Unreadable records by reason."""
    bad = ev.unreadable_events(ev.decode_values(_broken(_records(spark, sf_dir))))
    return bad.groupBy("reason").agg(F.count("*").alias("records"))


# Statistics and ranking


def user_statistics(spark, sf_dir):
    return _rounded(_stats(spark, sf_dir), "avg_wpm", "avg_accuracy", "wpm_variance")


def performance_level(spark, sf_dir):
    labelled = with_performance_level(_stats(spark, sf_dir))
    return _rounded(labelled.select("userId", "avg_wpm", "performance_level"), "avg_wpm")


def population_stats(spark, sf_dir):
    return _rounded(
        ranking.population_stats(_stats(spark, sf_dir)), "population_mean", "population_stddev"
    )


def global_rank(spark, sf_dir):
    ranked = ranking.with_global_rank(_stats(spark, sf_dir))
    return _rounded(ranked, "avg_wpm", "avg_accuracy", "wpm_variance")


def performance_trend(spark, sf_dir):
    labelled = ranking.with_performance_trend(_stats(spark, sf_dir))
    return _rounded(labelled.select("userId", "avg_wpm", "performance_trend"), "avg_wpm")


def result_records(spark, sf_dir):
    return _results(spark, sf_dir)


def result_json(spark, sf_dir):
    """Result records through their JSON form and back."""
    encoded = ranking.encode_results(_results(spark, sf_dir))
    schema = (
        "userId string, avg_wpm double, avg_accuracy double, keystroke_count bigint, "
        "global_rank string, performance_trend string, timestamp string"
    )
    return encoded.select("key", F.from_json("value", schema).alias("r")).select("key", "r.*")


# Serving


def stored_results(spark, sf_dir):
    return _stored(spark, sf_dir)


def latest_results(spark, sf_dir):
    """Last daily result of every user."""
    fields = ev.event_schema(("eventType", "userId", "timestamp"), ("wpm",))
    typed = ev.keystrokes(ev.events_of(_decoded(spark, sf_dir), ["KEYSTROKE"], fields))
    daily = typed.groupBy("userId", F.substring("timestamp", 1, 10).alias("day")).agg(
        F.avg("data.wpm").alias("avg_wpm"), F.count("*").alias("keystroke_count")
    )
    return _rounded(serving.latest_results(daily, order=["day"]), "avg_wpm")


def leaderboard(spark, sf_dir):
    return _board(spark, sf_dir)


def leaderboard_position(spark, sf_dir):
    return serving.with_position(_board(spark, sf_dir))


def leaderboard_snapshot(spark, sf_dir):
    """The leaderboard written as a version of a stored list and read back."""
    folder = run_folder(spark, "leaderboard")
    write_version(_board(spark, sf_dir), folder, 1)
    return read_version(spark, folder)


def lookup_with_default(spark, sf_dir):
    return serving.lookup_with_default(_requested(spark, sf_dir), _stored(spark, sf_dir))


def lookup_present(spark, sf_dir):
    return serving.lookup_present(_requested(spark, sf_dir), _stored(spark, sf_dir))


def known_users(spark, sf_dir):
    return serving.known_users(_requested(spark, sf_dir), _stored(spark, sf_dir))


def health_counts(spark, sf_dir):
    return serving.health_counts(session_users(_records(spark, sf_dir)), _stored(spark, sf_dir))


# Text scoring


def score_text(spark, sf_dir):
    return texts.score_text(_attempts(spark, sf_dir), ["doc_id"])


def char_status(spark, sf_dir):
    """Characters of each document by status."""
    status = texts.char_status(_attempts(spark, sf_dir), ["doc_id"])
    return status.groupBy("doc_id", "status").agg(F.count("*").alias("chars"))


def _emoji_attempts(spark, sf_dir):
    """Attempts on passages with characters of two UTF-16 units, typed right and wrong."""
    rows = _attempts(spark, sf_dir)
    return rows.withColumns({
        "quote": F.replace("quote", F.lit("a"), F.lit("\U0001f600")),
        "typed": F.replace(
            F.replace("typed", F.lit("a"), F.when(F.col("doc_id") % 2 == 0, "\U0001f600").otherwise("\U0001f601")),
            F.lit("o"), F.lit("\U0001f3b9"),
        ),
    })


def score_text_utf16(spark, sf_dir):
    """Scores by UTF-16 units."""
    return texts.score_text(_emoji_attempts(spark, sf_dir), ["doc_id"], utf16=True)


def char_status_runs(spark, sf_dir):
    """Stretches of equal status in each document."""
    return texts.char_status_runs(_attempts(spark, sf_dir), ["doc_id"])


def completion(spark, sf_dir):
    return texts.completion(_attempts(spark, sf_dir), ["doc_id"])


# Sessions

#: A low limit, to take the way for users with very many rows on small tables.
LOW_FLOOR = 20


def session_tracker(spark, sf_dir):
    return _shown_sessions(sessions.session_tracker(_marks(spark, sf_dir)))


def session_tracker_salted(spark, sf_dir):
    return _shown_sessions(sessions.session_tracker(_marks(spark, sf_dir), floor=LOW_FLOOR))


def _counted(rows: DataFrame) -> DataFrame:
    return rows.select("userId", "event_id", "eventType", "event_no")


def event_counter(spark, sf_dir):
    return _counted(sessions.event_counter(_marks(spark, sf_dir)))


def event_counter_sliced(spark, sf_dir):
    return _counted(sessions.event_counter(_marks(spark, sf_dir), floor=LOW_FLOOR))


# Streams: the stored table is replayed to its end, the stored outcome is returned


#: Micro-batches of a replay.
PARTS = 6
_parts: dict[tuple[str, str, str], tuple[str, int]] = {}


def _in_parts(spark, sf_dir, order="ts", events=None):
    """The stored events as files in ascending order, and the files of a micro-batch.

    Written once for a session.
    """
    known = (spark.sparkContext.applicationId, sf_dir, order)
    if known not in _parts:
        rows = _table(spark, sf_dir, "events") if events is None else events
        files = files_for(rows, PARTS)
        _parts[known] = write_in_parts(rows, order, PARTS, run_folder(spark, "replay"), files), files
    return _parts[known]


def _replay(spark, sf_dir):
    folder, files = _in_parts(spark, sf_dir)
    return typing_records(replay_parquet(use_utc(spark), folder, files_per_trigger=files))


def _complete_run(spark, sf_dir, label, shape=None):
    folder = run_folder(spark, label)
    query = sinks.start_batches(
        stats_of(_replay(spark, sf_dir)),
        [sinks.snapshot_writer(f"{folder}/out", shape)],
        f"{folder}/checkpoint",
        sinks.ALL_AVAILABLE,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), query


def stream_user_stats(spark, sf_dir):
    stats, _ = _complete_run(spark, sf_dir, "user-stats")
    return _rounded(stats, "avg_wpm", "avg_accuracy", "wpm_variance")


def stream_result_records(spark, sf_dir):
    results, _ = _complete_run(
        spark, sf_dir, "results", lambda stats: ranking.result_records(stats, _stamp())
    )
    return results


def stream_leaderboard(spark, sf_dir):
    board, _ = _complete_run(
        spark,
        sf_dir,
        "leaderboard",
        lambda stats: serving.leaderboard(serving.stored_results(ranking.result_records(stats))),
    )
    return board


def stream_stats_log(spark, sf_dir):
    """Update mode: changed users per batch in a log, newest row of each user."""
    folder = run_folder(spark, "stats-log")
    start_stats_log(_replay(spark, sf_dir), folder, sinks.ALL_AVAILABLE).awaitTermination()
    stats = current_stats(read_log(spark, f"{folder}/stats"))
    return _rounded(stats, "avg_wpm", "avg_accuracy", "wpm_variance")


def _session_run(spark, sf_dir):
    folder = run_folder(spark, "sessions")
    query = sinks.start_batches(
        stream_sessions(session_marks(_replay(spark, sf_dir))),
        [sinks.log_writer(f"{folder}/sessions")],
        f"{folder}/checkpoint",
        sinks.ALL_AVAILABLE,
        mode="update",
    )
    query.awaitTermination()
    log = read_log(spark, f"{folder}/sessions")
    return serving.latest_per_key(log, "userId", ["batch_id"]).drop("batch_id"), query


def stream_session_tracker(spark, sf_dir):
    return _shown_sessions(_session_run(spark, sf_dir)[0])


def stream_session_log(spark, sf_dir):
    """Session changes per batch in a log, folded into current sessions."""
    folder = run_folder(spark, "session-log")
    start_session_log(_replay(spark, sf_dir), folder, sinks.ALL_AVAILABLE).awaitTermination()
    return _shown_sessions(sessions.sessions_from_log(read_log(spark, f"{folder}/sessions")))


def stream_health(spark, sf_dir):
    tracked, session_query = _session_run(spark, sf_dir)
    results, result_query = _complete_run(spark, sf_dir, "results", ranking.result_records)
    return health(tracked, serving.stored_results(results), session_query, result_query)


# The service: micro-batches kept in a store, read afterwards


def _service_run(spark, sf_dir, records=None):
    folder = run_folder(spark, "service")
    records = _replay(spark, sf_dir) if records is None else records
    service.start_service(records, folder, sinks.ALL_AVAILABLE, bucket_rows=100).awaitTermination()
    return folder


def service_stats(spark, sf_dir):
    """Statistics out of moments that were merged over several batches."""
    stats = service.read_stats(spark, _service_run(spark, sf_dir))
    return _rounded(stats, "avg_wpm", "avg_accuracy", "wpm_variance")


def service_population(spark, sf_dir):
    """Population moments after changes were put in and taken out."""
    found = service.read_population(spark, _service_run(spark, sf_dir))
    row = [(found.users, float(found.mean), float(found.spread))]
    names = "users long, population_mean double, population_stddev double"
    return _rounded(spark.createDataFrame(row, names), "population_mean", "population_stddev")


def service_results(spark, sf_dir):
    return service.read_results(spark, _service_run(spark, sf_dir), _stamp())


def service_leaderboard(spark, sf_dir):
    return service.read_leaderboard(spark, _service_run(spark, sf_dir))


def service_lookup(spark, sf_dir):
    folder = _service_run(spark, sf_dir)
    return service.lookup_stored(spark, folder, _requested(spark, sf_dir), _stamp())


def service_unreadable(spark, sf_dir):
    """Unreadable records by reason, logged by the query that keeps the results."""
    folder = _service_run(spark, sf_dir, _broken(_replay(spark, sf_dir)))
    log = read_log(spark, f"{folder}/unreadable")
    return log.groupBy("reason").agg(F.count("*").alias("records"))


def stream_event_counter(spark, sf_dir):
    """Every event of a stream numbered, carried on from batch to batch."""
    folder = run_folder(spark, "counter")
    marks = session_marks(_replay(spark, sf_dir))
    counter.start_event_counter(marks, folder, sinks.ALL_AVAILABLE).awaitTermination()
    return _counted(counter.read_counted(spark, folder))


#: How far events are moved from their place in the shuffled replay.
DISORDER_HOURS = 48


def stream_sessions_in_order(spark, sf_dir):
    """Sessions by event time from batches that overlap by ``DISORDER_HOURS``."""
    moved = F.pmod(F.xxhash64("event_id"), F.lit(DISORDER_HOURS * 3600))
    events = _table(spark, sf_dir, "events").withColumn("arrival", F.unix_seconds(F.col("ts").cast("timestamp")) + moved)
    folder, files = _in_parts(spark, sf_dir, "arrival", events)
    records = typing_records(replay_parquet(spark, folder, files_per_trigger=files).drop("arrival"))
    out = run_folder(spark, "sessions")
    sinks.start_batches(
        in_order(session_marks(records), f"{DISORDER_HOURS} hours"),
        [sinks.log_writer(f"{out}/sessions")],
        f"{out}/checkpoint",
        sinks.ALL_AVAILABLE,
        mode="update",
    ).awaitTermination()
    log = read_log(spark, f"{out}/sessions")
    return _shown_sessions(serving.latest_per_key(log, "userId", ["batch_id"]))


def user_positions(spark, sf_dir):
    """The place of every user, not only of the first ten."""
    board = rankable(_stored(spark, sf_dir))
    return positions(board, [F.desc("avg_wpm"), "username"], slice_rows=100)


QUERIES: dict[str, Query] = {
    "parse_events": parse_events,
    "keystrokes": keystrokes,
    "routed_events": routed_events,
    "encode_events": encode_events,
    "enrich_events": enrich_events,
    "event_times": event_times,
    "test_outcomes": test_outcomes,
    "malformed_events": malformed_events,
    "user_stats": user_statistics,
    "performance_level": performance_level,
    "population_stats": population_stats,
    "global_rank": global_rank,
    "performance_trend": performance_trend,
    "result_records": result_records,
    "result_json": result_json,
    "stored_results": stored_results,
    "latest_results": latest_results,
    "leaderboard": leaderboard,
    "leaderboard_position": leaderboard_position,
    "leaderboard_snapshot": leaderboard_snapshot,
    "lookup_with_default": lookup_with_default,
    "lookup_present": lookup_present,
    "known_users": known_users,
    "health_counts": health_counts,
    "score_text": score_text,
    "char_status": char_status,
    "score_text_utf16": score_text_utf16,
    "char_status_runs": char_status_runs,
    "completion": completion,
    "session_tracker": session_tracker,
    "session_tracker_salted": session_tracker_salted,
    "event_counter": event_counter,
    "event_counter_sliced": event_counter_sliced,
    "stream_user_stats": stream_user_stats,
    "stream_result_records": stream_result_records,
    "stream_leaderboard": stream_leaderboard,
    "stream_stats_log": stream_stats_log,
    "stream_sessions": stream_session_tracker,
    "stream_session_log": stream_session_log,
    "stream_health": stream_health,
    "service_stats": service_stats,
    "service_population": service_population,
    "service_results": service_results,
    "service_leaderboard": service_leaderboard,
    "service_lookup": service_lookup,
    "service_unreadable": service_unreadable,
    "stream_event_counter": stream_event_counter,
    "stream_sessions_in_order": stream_sessions_in_order,
    "user_positions": user_positions,
}
