"""Per-user statistics and the level label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import performance_level


def user_stats(keystrokes: DataFrame, more_than: int = 2) -> DataFrame:
    """Average speed and accuracy, count and spread of every user's keystrokes.

    One hash aggregate with map-side combine: a user holding most of the rows
    still reaches the shuffle as one row per task. ``wpm_variance`` holds a
    sample standard deviation, under the name its readers expect.
    """
    return (
        keystrokes.groupBy("userId")
        .agg(
            F.avg("data.wpm").alias("avg_wpm"),
            F.avg("data.accuracy").alias("avg_accuracy"),
            F.count("*").alias("keystroke_count"),
            F.stddev_samp("data.wpm").alias("wpm_variance"),
        )
        .filter(F.col("keystroke_count") > more_than)
    )


def with_performance_level(stats: DataFrame) -> DataFrame:
    return stats.withColumn("performance_level", performance_level(F.col("avg_wpm")))
