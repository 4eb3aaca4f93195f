"""Finding keys that hold too many rows for one task.

A key is heavy when it holds more than ``max(floor, total / share)`` rows. At
most ``share`` keys can hold more than ``total / share`` rows each, so the list
of heavy keys is bounded whatever the data looks like, and may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows one task handles without trouble.
FLOOR = 10_000_000
#: Largest possible number of heavy keys.
SHARE = 100_000


def heavy_limit(
    profile: DataFrame, rows: str = "n", floor: int = FLOOR, share: int = SHARE
) -> Column:
    """Row count above which a key of ``profile`` (one row per key) is heavy.

    The subquery touches every column of the profile, so its shuffle is the one
    the caller's own use of the profile needs, and is run once.
    """
    others = [F.count(c).alias(f"n_{c}") for c in profile.columns if c != rows]
    total = profile.agg(F.struct(F.sum(rows).alias("total"), *others).alias("t")).scalar()
    return F.greatest(F.lit(floor), F.ceil(total.getField("total") / share))


def scatter(*parts: Column | str) -> Column:
    """A hash that spreads the rows of one key evenly, exact copies included.

    Copies hash alike, so the number of the reading task is mixed in. It is the
    same when a lost task is run again, unlike a random number.
    """
    return F.xxhash64(*parts, F.spark_partition_id())
