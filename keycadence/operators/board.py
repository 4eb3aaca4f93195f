"""The first places of a ranking, kept up under changes without ranking everybody.

Kept are candidates and a floor: everybody not among the candidates ranks behind the
floor. Changed users leave the candidates and come back if their new record ranks
before the floor or on it. As long as there are enough candidates their first places
are the true ones; only if too many have fallen behind are all users ranked again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .serving import LEADERBOARD_SIZE

#: Candidates kept, and rows that reach the driver at most.
CANDIDATES = 200
SHAPE = "username string, avg_wpm double, avg_accuracy double"


def rankable(stored: DataFrame) -> DataFrame:
    """The users that may be on the board, as its rows."""
    return stored.filter(F.col("avg_wpm") > 0).select(
        F.col("userId").alias("username"), "avg_wpm", "avg_accuracy"
    )


def _best(rows: DataFrame, size: int) -> list[list]:
    first = rows.orderBy(F.desc("avg_wpm"), "username").limit(size + 1).collect()
    return [list(r) for r in first]


def _not_behind(floor: list | None) -> Column:
    if floor is None:
        return F.lit(True)
    speed, name = F.lit(floor[1]), F.lit(floor[0])
    return (F.col("avg_wpm") > speed) | ((F.col("avg_wpm") == speed) & (F.col("username") <= name))


def board_from(rows: DataFrame, size: int = CANDIDATES) -> dict:
    """Candidates and floor out of all rankable users."""
    best = _best(rows, size)
    return {"candidates": best[:size], "floor": best[size - 1] if len(best) > size else None}


def board_after(
    board: dict,
    changed: DataFrame,
    everybody: Callable[[], DataFrame],
    size: int = CANDIDATES,
    places: int = LEADERBOARD_SIZE,
) -> dict:
    """The board once ``changed`` users have their new records.

    ``changed`` has a row for each changed user, without a speed for those that may not
    be on the board. ``everybody`` gives all rankable users and is used only if fewer than
    ``places`` candidates are left before the floor.
    """
    spark, floor = changed.sparkSession, board["floor"]
    held = candidates(spark, board)
    names = changed.select(F.col("username").alias("changed name"))
    stay = held.join(names, F.col("username") == F.col("changed name"), "left_anti")
    come = changed.filter((F.col("avg_wpm") > 0) & _not_behind(floor)).select(*held.columns)
    best = _best(stay.unionByName(come), size)
    if len(best) > size:
        return {"candidates": best[:size], "floor": best[size - 1]}
    if floor is not None and len(best) < places:
        return board_from(everybody(), size)
    return {"candidates": best, "floor": floor}


def candidates(spark: SparkSession, board: dict) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in board["candidates"]], SHAPE)


def first_places(spark: SparkSession, board: dict, places: int = LEADERBOARD_SIZE) -> DataFrame:
    """The leaderboard itself."""
    return spark.createDataFrame([tuple(r) for r in board["candidates"][:places]], SHAPE)
