"""Time expressions: ISO-8601 text, epoch milliseconds, the test countdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds a typing test lasts (fixed value).
TEST_SECONDS = 60

DAY_MILLIS = 86_400_000


def iso_utc(at: Column) -> Column:
    """ISO-8601 text in UTC with milliseconds, whatever the session time zone."""
    millis = F.unix_millis(at.cast("timestamp"))
    rest = F.pmod(millis, F.lit(DAY_MILLIS))
    day = F.date_from_unix_date(((millis - rest) / DAY_MILLIS).cast("int")).cast("string")
    units = ((3_600_000, 24, 2), (60_000, 60, 2), (1_000, 60, 2), (1, 1_000, 3))
    hour, minute, second, milli = (
        F.lpad((F.floor(rest / unit) % size).cast("string"), width, "0")
        for unit, size, width in units
    )
    return F.concat(day, F.lit("T"), F.concat_ws(":", hour, minute, second), F.lit("."), milli, F.lit("Z"))


def event_time(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, null where it is not one; UTC without a zone."""
    parsed = F.try_to_timestamp(text)
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})\s*$") & text.contains(":")
    return F.when(zoned, parsed).otherwise(F.from_utc_timestamp(parsed, F.current_timezone()))


def epoch_millis(at: Column) -> Column:
    """Milliseconds since the epoch as a double, the type the payload carries."""
    return F.unix_millis(at.cast("timestamp")).cast("double")


def from_epoch_millis(millis: Column) -> Column:
    """Timestamp of an epoch-millisecond number."""
    return F.timestamp_millis(millis.cast("long"))


def remaining_seconds(elapsed: Column, seconds: int = TEST_SECONDS) -> Column:
    """What the countdown shows after ``elapsed`` whole seconds; it stops at zero."""
    return F.greatest(F.lit(seconds) - elapsed, F.lit(0))


def elapsed_seconds(remaining: Column, seconds: int = TEST_SECONDS) -> Column:
    """Seconds gone by when the countdown shows ``remaining``."""
    return F.lit(seconds) - remaining
