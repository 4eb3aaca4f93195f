"""From raw records to typed events and back."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.times import event_time, iso_utc
from ..schema import (
    EVENT_SCHEMA,
    KEYSTROKE,
    OUTCOME_TYPES,
    PAYLOAD_TYPES,
    event_schema,
)


def decode_values(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Record bytes as text in a column ``json``; ``keep`` passes columns through."""
    return records.select(*keep, F.col("value").cast("string").alias("json"))


def parse_events(
    decoded: DataFrame, schema: StructType = EVENT_SCHEMA, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed events from ``json``; what does not parse becomes null fields.

    The generator keeps later filters from being pushed below the parse, where
    each filtered field would parse the text again.
    """
    return decoded.select(*keep, F.inline(F.array(F.from_json("json", schema))))


def may_hold(json: Column, word: str) -> Column:
    """False only if no JSON string in the text can spell ``word``.

    Letters have just two spellings inside JSON strings, themselves and a
    ``\\u`` escape, so this never drops a record that a parse would have kept.
    """
    return json.contains(word) | json.contains("\\u")


def events_of(decoded: DataFrame, kinds: Iterable[str], schema: StructType) -> DataFrame:
    """Events of the given kinds, cheaply: text check first, then a narrow parse."""
    kinds = list(kinds)
    likely = may_hold(F.col("json"), kinds[0])
    for kind in kinds[1:]:
        likely = likely | may_hold(F.col("json"), kind)
    return route(parse_events(decoded.filter(likely), schema), *kinds)


def route(events: DataFrame, *kinds: str) -> DataFrame:
    """Only the events of the given kinds."""
    return events.filter(F.col("eventType").isin(*kinds))


def keystrokes(events: DataFrame) -> DataFrame:
    """Keystrokes that carry a speed. A speed of zero counts, a missing one does not."""
    return events.filter((F.col("eventType") == KEYSTROKE) & F.col("data.wpm").isNotNull())


def keystroke_events(decoded: DataFrame) -> DataFrame:
    """``keystrokes`` straight from text, binding only the fields statistics use."""
    schema = event_schema(("eventType", "userId"), ("accuracy", "wpm"))
    return keystrokes(events_of(decoded, [KEYSTROKE], schema))


def test_outcomes(events: DataFrame) -> DataFrame:
    """Final score of every finished or timed-out test."""
    return route(events, *OUTCOME_TYPES).select(
        "userId",
        "eventType",
        F.col("data.finalWPM").alias("finalWPM"),
        F.col("data.finalAccuracy").alias("finalAccuracy"),
    )


def with_event_time(events: DataFrame) -> DataFrame:
    """Adds ``event_ts``, the parsed client time."""
    return events.withColumn("event_ts", event_time(F.col("timestamp")))


def unreadable_reason() -> Column:
    """Why a parsed record with its ``json`` gives no event at all, null if it does.

    ``empty`` has no text, ``malformed`` has text in which not one event field
    was found. One field of a wrong type does not make a record unreadable.
    """
    nothing = F.lit(True)
    for name in EVENT_SCHEMA.names:
        nothing = nothing & F.col(name).isNull()
    blank = F.col("json").isNull() | (F.trim("json") == "")
    return F.when(nothing, F.when(blank, "empty").otherwise("malformed"))


def unreadable_events(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Records that give no event at all, with the text and the reason."""
    found = parse_events(decoded, keep=[*keep, "json"])
    return found.select(*keep, "json", unreadable_reason().alias("reason")).filter(
        "reason IS NOT NULL"
    )


def service_events(decoded: DataFrame) -> DataFrame:
    """What a service needs of each record, from one parse.

    ``reason`` and ``json`` of records that cannot be read; kind, user, speed and
    accuracy of the others.
    """
    found = parse_events(decoded, keep=["json"]).select("*", unreadable_reason().alias("reason"))
    return found.select(
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("json")).alias("json"),
        "eventType",
        "userId",
        F.col("data.wpm").alias("wpm"),
        F.col("data.accuracy").alias("accuracy"),
    )


def with_non_empty_user(rows: DataFrame) -> DataFrame:
    """Drops rows without a user."""
    return rows.filter(F.col("userId").isNotNull() & (F.col("userId") != ""))


def derived_id(*parts: Column | str) -> Column:
    """Repeatable event id for replays."""
    return F.md5(F.concat_ws("|", *parts))


def enrich(
    events: DataFrame, event_id: Column | None = None, server_time: Column | None = None
) -> DataFrame:
    """Stamps each event with a unique id and the time it was received."""
    received = F.current_timestamp() if server_time is None else server_time
    return events.withColumn(
        "event_id", F.expr("uuid()") if event_id is None else event_id
    ).withColumn("server_timestamp", iso_utc(received))


def payload(**values: Column) -> Column:
    """Payload struct with every known field, null where not given."""
    unknown = set(values) - set(PAYLOAD_TYPES)
    if unknown:
        raise ValueError(f"unknown payload fields: {sorted(unknown)}")
    return F.struct(
        *[
            values.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in PAYLOAD_TYPES.items()
        ]
    )


def envelope(at: Column, kind: Column, user: Column, data: Column, **more: Column) -> Column:
    """The record a client emits, as a struct; ``more`` adds fields such as ``event_id``."""
    return F.struct(
        iso_utc(at).alias("timestamp"),
        kind.alias("eventType"),
        user.alias("userId"),
        *[value.alias(name) for name, value in more.items()],
        data.alias("data"),
    )


def encode_events(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Key and JSON bytes for a topic or a log; null fields are left out.

    Keyed by user, so a topic keeps each user's events in order.
    """
    record = F.to_json(F.struct(*[c for c in events.columns if c not in keep]))
    return events.select(*keep, F.col("userId").alias("key"), record.cast("binary").alias("value"))
