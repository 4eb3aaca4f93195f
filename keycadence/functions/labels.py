"""The labels put on users, all in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds (words per minute, lower bound inclusive) and labels.
LEVELS = (
    (60, "🏆 EXPERT"),
    (40, "👍 INTERMEDIATE"),
    (20, "📚 BEGINNER"),
)
LEVEL_OTHERWISE = "🎯 PRACTICE NEEDED"

TRENDS = (
    (50, "🚀 FAST TYPIST"),
    (30, "👍 MODERATE"),
)
TREND_OTHERWISE = "📚 LEARNING"

BAND_NO_POPULATION = "⭐ FIRST TEST"
BAND_TOP = "🏆 TOP 10%"
BAND_ABOVE = "📈 ABOVE AVERAGE"
BAND_AVERAGE = "📊 AVERAGE"
BAND_BELOW = "🎯 NEEDS PRACTICE"


def stepped(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose lower bound ``value`` reaches."""
    (bound, label), *rest = steps
    chain = F.when(value >= bound, label)
    for bound, label in rest:
        chain = chain.when(value >= bound, label)
    return chain.otherwise(otherwise)


def performance_level(avg_wpm: Column) -> Column:
    return stepped(avg_wpm, LEVELS, LEVEL_OTHERWISE)


def performance_trend(avg_wpm: Column) -> Column:
    return stepped(avg_wpm, TRENDS, TREND_OTHERWISE)


def rank_band(avg_wpm: Column, mean: Column, spread: Column) -> Column:
    """Band of a user relative to the population mean, on unrounded values."""
    no_population = mean.isNull() | (mean <= 0)
    return (
        F.when(no_population, BAND_NO_POPULATION)
        .when(avg_wpm > mean + spread, BAND_TOP)
        .when(avg_wpm > mean, BAND_ABOVE)
        .when(avg_wpm > mean - spread, BAND_AVERAGE)
        .otherwise(BAND_BELOW)
    )
