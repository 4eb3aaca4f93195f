"""Typing records derived from the generic ``events`` and ``documents`` tables.

The tables at hand hold no typing data, so the queries that show and check the
operators map their columns onto typing events, as JSON bytes like a topic's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import half_up
from ..functions.times import epoch_millis
from ..operators.events import derived_id, encode_events, envelope, payload


def typing_events(events: DataFrame) -> DataFrame:
    """One typing event per row of ``events``, columns as a client emits them."""
    rows = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    source, k, at = F.col("event_type"), F.col("k"), F.col("ts")
    click, timeout = source == "click", (source == "error") & (k < 50)
    kind = (
        F.when(click, "KEYSTROKE")
        .when(source == "view", "TEST_START")
        .when(source == "signup", "SESSION_START")
        .when(source == "purchase", "TEST_COMPLETE")
        .when(k < 50, "TEST_TIMEOUT")
        .otherwise("TEST_RESTART")
    )
    score, speed = 100 - k % 40, half_up(F.col("value"))
    ended = (source == "purchase") | timeout
    data = payload(
        accuracy=F.when(click & (k % 20 != 7), score),
        wpm=F.when(click & (k % 10 != 9), speed),
        correct=F.when(click, F.floor((1 + k) * score / F.lit(100.0))),
        total=F.when(click, 1 + k),
        finalWPM=F.when(ended, speed),
        finalAccuracy=F.when(ended, score),
        quote=F.when(source == "view", F.concat(F.lit("passage "), (k % 7).cast("string"))),
        timestamp=F.when(source != "purchase", epoch_millis(at)),
    )
    event = envelope(
        at,
        kind,
        F.concat(F.lit("u"), (F.col("user_id") * 4 + k % 4).cast("string")),
        data,
        event_id=derived_id(F.col("event_id").cast("string"), source),
    )
    return rows.select(event.alias("event")).select("event.*")


def typing_records(events: DataFrame) -> DataFrame:
    """``typing_events`` as ``key`` and ``value`` bytes.

    The generator stands for the border between a producer and its readers: a
    reader's filter on the bytes must not run the encoding a second time.
    """
    encoded = encode_events(typing_events(events))
    return encoded.select("key", F.explode(F.array("value")).alias("value"))


def typing_attempts(documents: DataFrame) -> DataFrame:
    """One typing attempt per document: the whole text is the passage.

    By ``doc_id`` the typed text is the passage itself, the passage with wrong
    characters, without its spaces (shorter), with extra characters (longer), or
    empty.
    """
    text, variant = F.col("text"), F.col("doc_id") % 5
    typed = (
        F.when(variant == 0, text)
        .when(variant == 1, F.translate(text, "e", "3"))
        .when(variant == 2, F.replace(text, F.lit(" "), F.lit("")))
        .when(variant == 3, F.concat(text, F.lit(" "), F.col("lang")))
        .otherwise("")
    )
    return documents.select(
        "doc_id",
        text.alias("quote"),
        typed.alias("typed"),
        (F.col("doc_id") % 61).cast("int").alias("elapsed"),
    )
