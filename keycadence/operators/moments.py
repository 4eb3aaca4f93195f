"""Statistics that are kept up by adding what is new and taking back what was.

A user's keystrokes are summed up as counts, whole sums and the second moment; two
such summaries merge into that of both (the parallel form of the variance). The
population is the same over the users' averages: a user whose average has changed is
taken out with the old one and put in with the new one, so that no other user is read.
"""

from __future__ import annotations

from math import sqrt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import DEFAULT_SPREAD

MORE_THAN = 2
#: Loss of digits by taking out nearly everything; the moments are then counted anew.
LOSS = 1e-6
#: A spread this small against the mean is rounding: all averages are equal.
NO_SPREAD = 1e-9


def key_moments(keystrokes: DataFrame) -> DataFrame:
    """``userId, n, speed, m2, n_accuracy, accuracy`` from ``userId, wpm, accuracy``."""
    return keystrokes.groupBy("userId").agg(
        F.count("*").alias("n"),
        F.sum(F.col("wpm").cast("long")).alias("speed"),
        (F.var_pop("wpm") * F.count("*")).alias("m2"),
        F.count("accuracy").alias("n_accuracy"),
        F.coalesce(F.sum(F.col("accuracy").cast("long")), F.lit(0)).alias("accuracy"),
    )


def merged_moments(fresh: DataFrame, known: DataFrame | None) -> DataFrame:
    """``fresh`` moments with those ``known`` of the same users added.

    ``was`` is the user's average before, null if it did not count. Users that are not
    in ``fresh`` are not in the result.
    """
    names = ["n", "speed", "m2", "n_accuracy", "accuracy"]
    if known is None:
        return fresh.select("userId", *names, F.lit(None).cast("double").alias("was"))
    before = known.select(F.col("userId").alias("known user"), *[F.col(c).alias(f"old {c}") for c in names])
    joined = fresh.join(before, F.col("userId").eqNullSafe(F.col("known user")), "left")
    old = {c: F.coalesce(f"old {c}", F.lit(0)) for c in names}
    apart = F.col("speed") / F.col("n") - F.col("old speed") / F.col("old n")
    between = apart * apart * (F.col("n") * F.col("old n") / (F.col("n") + F.col("old n")))
    sums = {c: F.col(c) + old[c] for c in names}
    sums["m2"] = F.col("m2") + old["m2"] + F.coalesce(between, F.lit(0.0))
    was = F.when(F.col("old n") > MORE_THAN, F.col("old speed") / F.col("old n"))
    return joined.select("userId", *[v.alias(c) for c, v in sums.items()], was.alias("was"))


def counted_average() -> Column:
    """A user's average if there are enough keystrokes for it to count, else null."""
    return F.when(F.col("n") > MORE_THAN, F.col("speed") / F.col("n"))


def stats_from_moments(moments: DataFrame) -> DataFrame:
    """The statistics ``user_stats`` would give for all keystrokes seen."""
    return moments.filter(F.col("n") > MORE_THAN).select(
        "userId",
        (F.col("speed") / F.col("n")).alias("avg_wpm"),
        F.when(F.col("n_accuracy") > 0, F.col("accuracy") / F.col("n_accuracy")).alias("avg_accuracy"),
        F.col("n").alias("keystroke_count"),
        F.sqrt(F.col("m2") / (F.col("n") - 1)).alias("wpm_variance"),
    )


class Population(NamedTuple):
    """Number, mean and second moment of the averages that count."""

    users: int = 0
    mean: float = 0.0
    m2: float = 0.0

    def plus(self, other: Population) -> Population:
        users = self.users + other.users
        if not users or not other.users:
            return self
        apart = other.mean - self.mean
        mean = self.mean + apart * other.users / users
        m2 = self.m2 + other.m2 + apart * apart * self.users * other.users / users
        return Population(users, mean, m2)

    def minus(self, other: Population) -> Population | None:
        """Without the averages of ``other``; None if too few digits would be left."""
        if not other.users:
            return self
        users = self.users - other.users
        if users <= 0:
            return Population() if users == 0 else None
        mean = (self.users * self.mean - other.users * other.mean) / users
        if not self.m2:
            return Population(users, mean, 0.0)
        apart = other.mean - mean
        m2 = self.m2 - other.m2 - apart * apart * users * other.users / self.users
        return Population(users, mean, m2) if m2 > LOSS * self.m2 else None

    @property
    def spread(self) -> float:
        """Sample deviation, or the fixed one where there is none."""
        found = sqrt(self.m2 / (self.users - 1)) if self.users > 1 and self.m2 > 0 else 0.0
        return found if found > NO_SPREAD * max(1.0, abs(self.mean)) else DEFAULT_SPREAD


def _population(average: Column) -> Column:
    count = F.count(average)
    moment = F.coalesce(F.var_pop(average) * count, F.lit(0.0))
    return F.struct(count, F.coalesce(F.avg(average), F.lit(0.0)), moment)


def population_of(moments: DataFrame) -> Population:
    """The population counted from all users."""
    return Population(*moments.agg(_population(counted_average())).first()[0])


def population_after(before: Population, changed: DataFrame) -> Population | None:
    """The population once ``changed`` users have their new averages.

    Reads the changed users only. None if it has to be counted anew.
    """
    gone, come = changed.agg(
        _population(F.col("was")).alias("gone"), _population(counted_average()).alias("come")
    ).first()
    left = before.minus(Population(*gone))
    return left.plus(Population(*come)) if left is not None else None
