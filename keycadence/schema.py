"""The typing-event record: field names, types and the event vocabulary."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# The event vocabulary.
SESSION_START = "SESSION_START"
TEST_START = "TEST_START"
KEYSTROKE = "KEYSTROKE"
TEST_COMPLETE = "TEST_COMPLETE"
TEST_TIMEOUT = "TEST_TIMEOUT"
TEST_RESTART = "TEST_RESTART"

#: Kinds that close a test and carry a final score.
OUTCOME_TYPES = (TEST_COMPLETE, TEST_TIMEOUT)
#: Kinds that start a new running event count.
RESET_TYPES = (SESSION_START, TEST_RESTART)

# Payload fields and their types.
PAYLOAD_TYPES = {
    "accuracy": IntegerType(),
    "wpm": IntegerType(),
    "correct": IntegerType(),
    "total": IntegerType(),
    "finalWPM": IntegerType(),
    "finalAccuracy": IntegerType(),
    "quote": StringType(),
    "timestamp": DoubleType(),
}

# Top-level string fields.
EVENT_FIELDS = ("eventType", "userId", "timestamp", "event_id", "server_timestamp")


def event_schema(
    fields: Iterable[str] = EVENT_FIELDS, payload: Iterable[str] = tuple(PAYLOAD_TYPES)
) -> StructType:
    """Schema of one event, or of the part of it a query needs.

    JSON parsing cost grows with the number of fields bound, and Catalyst does
    not prune a nested parse schema by itself, so narrow queries ask for a
    narrow schema.
    """
    columns = [StructField(name, StringType()) for name in fields]
    inner = [StructField(name, PAYLOAD_TYPES[name]) for name in payload]
    if inner:
        columns.append(StructField("data", StructType(inner)))
    return StructType(columns)


EVENT_SCHEMA = event_schema()
