"""Placing every user relative to the whole population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import performance_trend, rank_band
from ..functions.numbers import or_default, tenths
from ..functions.times import iso_utc

#: Spread used where the population has none (fixed value).
DEFAULT_SPREAD = 10.0


def _mean() -> Column:
    return or_default(F.avg("avg_wpm"), 0.0)


def _spread() -> Column:
    return or_default(F.stddev_samp("avg_wpm"), DEFAULT_SPREAD)


def population_stats(stats: DataFrame) -> DataFrame:
    """One row: number of users, mean and spread of the user averages.

    Every user weighs the same, whatever the number of keystrokes.
    """
    return stats.agg(
        F.count("*").alias("users"),
        _mean().alias("population_mean"),
        _spread().alias("population_stddev"),
    )


def with_global_rank(stats: DataFrame) -> DataFrame:
    """Adds ``global_rank``, the band relative to population mean and spread.

    The two population numbers come from a scalar subquery: no join, no
    collected rows, no single-partition window. The subquery also counts the
    other columns of ``stats``. They would otherwise be pruned away there, its
    shuffle would differ from the one of the outer query, and the events would
    be read and aggregated twice; this way Spark reuses the one exchange.
    """
    others = [c for c in stats.columns if c not in ("userId", "avg_wpm")]
    population = stats.agg(
        F.struct(
            _mean().alias("mean"),
            _spread().alias("spread"),
            *[F.count(c).alias(f"n_{c}") for c in others],
        ).alias("population")
    ).scalar()
    ranked = stats.withColumn("population", population)
    return ranked.withColumn(
        "global_rank",
        rank_band(F.col("avg_wpm"), F.col("population.mean"), F.col("population.spread")),
    ).drop("population")


def with_rank_against(stats: DataFrame, mean: float, spread: float) -> DataFrame:
    """Adds ``global_rank`` against a population that is known already."""
    band = rank_band(F.col("avg_wpm"), F.lit(mean), F.lit(spread))
    return stats.withColumn("global_rank", band)


def with_performance_trend(stats: DataFrame) -> DataFrame:
    return stats.withColumn("performance_trend", performance_trend(F.col("avg_wpm")))


def result_records(
    stats: DataFrame, at: Column | None = None, population: tuple[float, float] | None = None
) -> DataFrame:
    """The record delivered per user: rounded averages, count, band, trend, time.

    Bands are taken on unrounded averages, against the mean and spread of ``stats``
    or those given as ``population``. A missing accuracy stays null.
    """
    narrow = stats.select("userId", "avg_wpm", "avg_accuracy", "keystroke_count")
    ranked = with_rank_against(narrow, *population) if population else with_global_rank(narrow)
    return with_performance_trend(ranked).select(
        "userId",
        tenths(F.col("avg_wpm")).alias("avg_wpm"),
        tenths(F.col("avg_accuracy")).alias("avg_accuracy"),
        F.col("keystroke_count").cast("long").alias("keystroke_count"),
        "global_rank",
        "performance_trend",
        iso_utc(F.current_timestamp() if at is None else at).alias("timestamp"),
    )


def encode_results(records: DataFrame) -> DataFrame:
    """One JSON text per result record, keyed by user."""
    return records.select(
        F.col("userId").alias("key"), F.to_json(F.struct(*records.columns)).alias("value")
    )
