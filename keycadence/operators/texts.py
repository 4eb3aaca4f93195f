"""Scoring typed text against its passage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import (
    CORRECT,
    INCORRECT,
    PENDING,
    accuracy,
    code_points,
    correct_chars,
    correct_units,
    is_complete,
    is_timed_out,
    status_runs,
    utf16_length,
    utf16_units,
    words_per_minute,
)
from ..functions.times import remaining_seconds


def score_text(attempts: DataFrame, keep: Sequence[str], utf16: bool = False) -> DataFrame:
    """Correct and total characters, accuracy and speed of every attempt.

    Expects ``typed``, ``quote`` and ``elapsed`` (whole seconds). Characters are code
    points, or UTF-16 units as a browser counts them.
    """
    typed, quote = F.col("typed"), F.col("quote")
    counted = attempts.select(
        *keep,
        "elapsed",
        (correct_units if utf16 else correct_chars)(typed, quote).alias("correct"),
        (utf16_length if utf16 else F.length)(typed).alias("total"),
    )
    return counted.select(
        *keep,
        "correct",
        "total",
        accuracy(F.col("correct"), F.col("total")).alias("accuracy"),
        words_per_minute(F.col("total"), F.col("elapsed")).alias("wpm"),
    )


def char_status(attempts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per passage character: ``pos``, ``expected`` and its status.

    Both texts are split once; only the passage is exploded and the typed
    character is picked by index, so the work is linear in the text.
    """
    split = attempts.select(
        *keep,
        F.when(F.length("typed") > 0, F.split("typed", "")).otherwise(F.array()).alias("typed"),
        F.when(F.length("quote") > 0, F.split("quote", "")).otherwise(F.array()).alias("quote"),
    )
    placed = split.select(*keep, "typed", F.posexplode_outer("quote").alias("pos", "expected"))
    # a filter after an outer generator stays behind it, so no text is split again
    placed = placed.filter("pos IS NOT NULL")
    status = (
        F.when(F.col("pos") >= F.size("typed"), PENDING)
        .when(F.get("typed", F.col("pos")) == F.col("expected"), CORRECT)
        .otherwise(INCORRECT)
    )
    return placed.select(*keep, "pos", "expected", status.alias("status"))


def char_status_runs(
    attempts: DataFrame, keep: Sequence[str], utf16: bool = False
) -> DataFrame:
    """``char_status`` by stretches: ``start``, ``length`` and ``status`` of each.

    As many rows as the status changes along the passage, not one per character.
    """
    split = utf16_units if utf16 else code_points
    texts = attempts.filter(F.col("quote").isNotNull()).select(
        *keep,
        split(F.coalesce("typed", F.lit(""))).alias("typed"),
        split(F.col("quote")).alias("quote"),
    )
    return texts.select(*keep, F.inline(status_runs(F.col("typed"), F.col("quote"))))


def completion(attempts: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Whether each attempt is complete or timed out, and the seconds left."""
    elapsed = F.col("elapsed")
    return attempts.select(
        *keep,
        is_complete(F.col("typed"), F.col("quote"), elapsed).alias("is_complete"),
        is_timed_out(elapsed).alias("is_timed_out"),
        remaining_seconds(elapsed).alias("remaining"),
        F.length("quote").alias("quote_length"),
    )
