"""Typing scores as column expressions over the typed text and the passage.

Positions are code points or, as in a browser, UTF-16 units: there a character outside
the Basic Multilingual Plane counts as two, which may be right and wrong one by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import half_up
from .times import TEST_SECONDS

# Status names and characters per word.
CORRECT = "correct"
INCORRECT = "incorrect"
PENDING = "pending"
CHARS_PER_WORD = 5


def code_points(text: Column) -> Column:
    """The characters of a text as an array; the empty array for the empty text."""
    return F.when(F.length(text) > 0, F.split(text, "")).otherwise(F.array().cast("array<string>"))


def utf16_units(text: Column) -> Column:
    """The UTF-16 units of a text as an array of four hexadecimal digits each."""
    digits = F.hex(F.encode(text, "UTF-16BE"))
    return F.regexp_extract_all(digits, F.lit("(.{4})"), 1)


def utf16_length(text: Column) -> Column:
    """Number of UTF-16 units, two for a character of four bytes in UTF-8."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def correct_units(typed: Column, passage: Column) -> Column:
    """``correct_chars`` by UTF-16 units."""
    places = F.zip_with(utf16_units(typed), utf16_units(passage), lambda t, p: t.eqNullSafe(p))
    return F.size(F.filter(places, lambda same: same))


def status_runs(typed: Column, passage: Column) -> Column:
    """Stretches of equal status over the passage, from two arrays of characters.

    An array of ``start, length, status``. A stretch begins where a place differs from
    the one before it, so the work is linear and nothing is kept per character.
    """
    shared = F.least(F.size(typed), F.size(passage))
    same = F.zip_with(
        F.slice(typed, F.lit(1), shared), F.slice(passage, F.lit(1), shared), lambda t, p: t == p
    )

    def stretches(same: Column) -> Column:
        marked = F.transform(
            same,
            lambda x, i: F.struct(
                i.alias("start"), x.alias("right"),
                ((i == 0) | (x != F.get(same, i - 1))).alias("first"),
            ),
        )
        return F.filter(marked, lambda place: place["first"])

    def spans(starts: Column) -> Column:
        ends = F.concat(
            F.transform(F.slice(starts, 2, F.size(starts)), lambda place: place["start"]),
            F.array(shared),
        )
        typed_spans = F.zip_with(
            starts,
            ends,
            lambda place, end: F.struct(
                place["start"].alias("start"),
                (end - place["start"]).alias("length"),
                F.when(place["right"], CORRECT).otherwise(INCORRECT).alias("status"),
            ),
        )
        rest = F.struct(
            shared.alias("start"),
            (F.size(passage) - shared).alias("length"),
            F.lit(PENDING).alias("status"),
        )
        found = F.concat(F.filter(typed_spans, lambda s: s["length"] > 0), F.array(rest))
        return F.filter(found, lambda s: s["length"] > 0)

    # each step is bound once, however often it is used
    starts = F.transform(F.array(same), stretches)
    return F.transform(starts, spans)[0]


def correct_chars(typed: Column, passage: Column) -> Column:
    """How many typed characters equal the passage character at their place.

    The null-safe comparison turns a place only one text has into a plain
    ``false``, so surplus and missing characters need no case of their own.
    """
    places = F.zip_with(F.split(typed, ""), F.split(passage, ""), lambda t, p: t.eqNullSafe(p))
    matches = F.size(F.filter(places, lambda same: same))
    return F.when((F.length(typed) == 0) | (F.length(passage) == 0), 0).otherwise(matches)


def accuracy(correct: Column, total: Column) -> Column:
    """Percentage of typed characters that are right; 100 before the first one."""
    return F.when(total > 0, half_up(correct / total * 100)).otherwise(100)


def words_per_minute(total: Column, elapsed: Column) -> Column:
    """Typing speed; 0 until the first second has passed."""
    words = total / CHARS_PER_WORD
    minutes = elapsed / 60
    return F.when(elapsed > 0, half_up(words / minutes)).otherwise(0)


def is_complete(
    typed: Column, passage: Column, elapsed: Column, seconds: int = TEST_SECONDS
) -> Column:
    """The passage was typed in full with time left."""
    return (typed == passage) & (elapsed < seconds)


def is_timed_out(elapsed: Column, seconds: int = TEST_SECONDS) -> Column:
    """The countdown has run out."""
    return elapsed >= seconds
