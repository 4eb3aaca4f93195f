"""Running totals and positions over all rows, without a window that holds them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import run_folder

#: Rows one task is meant to number.
SLICE_ROWS = 1_000_000


def in_slices(
    rows: DataFrame, order: Sequence[Column | str], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """The rows cut into ranges of ``order``, with the number of the range as ``slice``.

    Range borders come from a sample, so the cut rows are written once below the
    shared folder: all that is derived from them sees the same borders, also when
    an executor is lost.
    """
    spark = rows.sparkSession
    slices = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // slice_rows + 1
    )
    cut = rows.repartitionByRange(slices, *order).withColumn("slice", F.spark_partition_id())
    folder = run_folder(spark, "slices")
    cut.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(cut.schema).parquet(folder)


def running_total(
    rows: DataFrame,
    order: Sequence[Column | str],
    value: Column,
    group: Sequence[str] = (),
    name: str = "before",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows ahead of each row, within its ``group``.

    A two-level prefix sum. Each slice is summed up on its own, and a slice hands
    one number per group to those after it, so a group of any size is spread over
    as many tasks as it fills. ``order`` must tell rows apart; rows it does not
    tell apart stay in one slice. ``value`` is not negative and never null.
    """
    keys = [*group, "slice"]
    cut = in_slices(rows, [*group, *order], slice_rows)
    sums = cut.groupBy(*keys).agg(F.sum(value).alias("total"))
    if group:
        earlier = Window.partitionBy(*group).orderBy("slice").rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = sums.select(*keys, F.sum("total").over(earlier).alias("carried"))
    else:
        carried = _prefix_of_slices(sums)
    ahead = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = cut.withColumn("here", F.coalesce(F.sum(value).over(ahead), F.lit(0)))
    right = carried.select(*[F.col(k).alias(f"{k} of total") for k in keys], "carried")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"{key} of total"))
    return (
        here.join(right, same, "left")
        .withColumn(name, F.col("here") + F.coalesce("carried", F.lit(0)))
        .select(*rows.columns, name)
    )


def _prefix_of_slices(sums: DataFrame) -> DataFrame:
    """Total of the slices ahead of each; one number per slice goes through the driver."""
    carried, rows = 0, []
    for number, total in sums.orderBy("slice").collect():
        rows.append((number, carried))
        carried += total
    return F.broadcast(sums.sparkSession.createDataFrame(rows, "slice int, carried long"))


def positions(rows: DataFrame, order: Sequence[Column | str], **how: int) -> DataFrame:
    """Numbers all rows from 1 in ``order``, as ``position``."""
    ahead = running_total(rows, order, F.lit(1), name="position", **how)
    return ahead.withColumn("position", (F.col("position") + 1).cast("long"))
