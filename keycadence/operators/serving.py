"""What readers ask for: latest results, lookups, leaderboard, health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import tenths
from ..functions.times import iso_utc
from .events import with_non_empty_user

# What a missing field or an unknown user reads as.
NO_NUMBER = 0
NO_RANK = "N/A"
NO_TREND = "stable"

LEADERBOARD_SIZE = 10


def latest_per_key(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of every key by the ``order`` columns.

    A maximum over a struct combines on the map side, so a key with very many
    versions never meets in one task the way a ranking window would make it.
    """
    payload = [c for c in log.columns if c not in (key, *order)]
    newest = F.max(F.struct(*order, F.struct(*payload).alias("rest"))).alias("newest")
    return (
        log.groupBy(key)
        .agg(newest)
        .select(
            key,
            *[F.col(f"newest.{c}").alias(c) for c in order],
            *[F.col(f"newest.rest.{c}").alias(c) for c in payload],
        )
        .select(*log.columns)
    )


def latest_results(
    log: DataFrame, order: Sequence[str] = ("timestamp", "batch_id"), key: str = "userId"
) -> DataFrame:
    """Last written result of every user; results without a user are not kept."""
    return latest_per_key(with_non_empty_user(log), key, order)


def stored_results(records: DataFrame, at: Column | None = None) -> DataFrame:
    """Result records in stored form: defaults filled in, ``last_update`` stamped."""
    stamp = iso_utc(F.current_timestamp() if at is None else at)
    return with_non_empty_user(records).select(
        "userId",
        F.coalesce(tenths(F.col("avg_wpm")), F.lit(NO_NUMBER)).alias("avg_wpm"),
        F.coalesce(tenths(F.col("avg_accuracy")), F.lit(NO_NUMBER)).alias("avg_accuracy"),
        F.coalesce("keystroke_count", F.lit(NO_NUMBER)).alias("total_keystrokes"),
        F.coalesce("global_rank", F.lit(NO_RANK)).alias("global_rank"),
        F.coalesce("performance_trend", F.lit(NO_TREND)).alias("performance_trend"),
        stamp.alias("last_update"),
    )


def leaderboard(stored: DataFrame, size: int = LEADERBOARD_SIZE) -> DataFrame:
    """The fastest users by stored (rounded) speed, equal speeds by name.

    Sort and limit become one top-k operator: each task keeps ``size`` rows.
    """
    return (
        stored.filter(F.col("avg_wpm") > 0)
        .select(F.col("userId").alias("username"), "avg_wpm", "avg_accuracy")
        .orderBy(F.desc("avg_wpm"), "username")
        .limit(size)
    )


def with_position(board: DataFrame) -> DataFrame:
    """Numbers the rows of a leaderboard; meant for its few rows, after the limit."""
    order = Window.orderBy(F.desc("avg_wpm"), "username")
    return board.select(F.row_number().over(order).cast("long").alias("position"), "*")


def lookup_with_default(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored records of the requested users, defaults and no stamp for unknown ones."""
    defaults = {
        "avg_wpm": NO_NUMBER,
        "avg_accuracy": NO_NUMBER,
        "total_keystrokes": NO_NUMBER,
        "global_rank": NO_RANK,
        "performance_trend": NO_TREND,
        "last_update": None,
    }
    # A known user's own nulls stay null, as in the stored record.
    found = stored.select("userId", *defaults, F.lit(True).alias("known"))
    joined = requested.join(found, "userId", "left")
    return joined.select(
        *requested.columns,
        *[
            F.when(F.col("known"), F.col(name)).otherwise(F.lit(default)).alias(name)
            for name, default in defaults.items()
        ],
    )


def lookup_present(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored statistics of those requested users that have any.

    No broadcast hint: stored results grow with the users, so the join strategy
    is left to Spark's own size check.
    """
    return with_non_empty_user(requested).join(stored, "userId", "inner")


def known_users(requested: DataFrame, stored: DataFrame) -> DataFrame:
    """Requested users that have a stored result, without the result."""
    return requested.join(stored, "userId", "left_semi")


def health_counts(sessions: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: users with a session and users with a result, from one row per user each."""
    return sessions.agg(F.count("*").alias("active_sessions")).withColumn(
        "spark_analytics_count", stored.agg(F.count("*")).scalar()
    )
