"""The analytic chain, the same for a stored log and for a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.events import (
    decode_values,
    events_of,
    keystroke_events,
    parse_events,
    with_event_time,
)
from ..operators.ranking import result_records
from ..operators.serving import latest_per_key
from ..operators.sessions import session_changes
from ..operators.stats import user_stats, with_performance_level
from ..schema import SESSION_START, event_schema
from ..streaming import service
from ..streaming.sinks import every, log_writer, preview_writer, start_batches


def stats_of(records: DataFrame) -> DataFrame:
    """Labelled per-user statistics of raw records."""
    return with_performance_level(user_stats(keystroke_events(decode_values(records))))


def results_of(records: DataFrame, at: Column | None = None) -> DataFrame:
    """Result records of a stored log of raw records."""
    return result_records(user_stats(keystroke_events(decode_values(records))), at)


def session_marks(records: DataFrame) -> DataFrame:
    """What sessions and counters need of each event, and no more."""
    schema = event_schema(("eventType", "userId", "timestamp", "event_id"), ())
    events = with_event_time(parse_events(decode_values(records), schema))
    return events.filter("eventType IS NOT NULL").drop("timestamp")


def session_users(records: DataFrame) -> DataFrame:
    """The users that ever started a session; enough for counting sessions."""
    starts = events_of(
        decode_values(records), [SESSION_START], event_schema(("eventType", "userId"), ())
    )
    return starts.filter("userId IS NOT NULL").select("userId").distinct()


def start_service(
    records: DataFrame, folder: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """The service over a stream of records: results, and what could not be read.

    One query reads and parses the records once, keeps changed users in a keyed store,
    logs unreadable records under ``unreadable`` and prints a preview. ``folder`` must be
    durable; it takes the checkpoint as well. ``streaming.service`` has the readers.
    """
    preview = preview_writer(shape=lambda batch: batch.filter("reason IS NULL").drop("reason", "json"))
    return [service.start_service(records, folder, trigger, preview)]


def start_stats_log(
    records: DataFrame, folder: str, trigger: dict | None = None
) -> StreamingQuery:
    """Statistics for very many users: each batch writes only users that changed.

    Complete mode rewrites every user on each trigger. Here the changed ones are
    appended to a log; ``current_stats`` reads the newest row of each user, and
    ranking runs on that whenever it is asked for.
    """
    return start_batches(
        stats_of(records),
        [log_writer(f"{folder}/stats")],
        f"{folder}/checkpoints/stats",
        trigger or every(15),
        mode="update",
    )


def current_stats(log: DataFrame) -> DataFrame:
    """Newest statistics of every user in a log written by ``start_stats_log``."""
    return latest_per_key(log, "userId", ["batch_id"]).drop("batch_id")


def start_session_log(
    records: DataFrame, folder: str, trigger: dict | None = None
) -> StreamingQuery:
    """Sessions for streams in which one user may fill a micro-batch.

    ``stream_sessions`` takes a user's part of a micro-batch into one task. Here
    each micro-batch is summed up per user by the batch operator, which spreads
    large users, and the changes go to a log; ``sessions_from_log`` reads it.
    """
    return start_batches(
        session_marks(records),
        [log_writer(f"{folder}/sessions", session_changes)],
        f"{folder}/checkpoints/sessions",
        trigger or every(15),
        mode="append",
    )
