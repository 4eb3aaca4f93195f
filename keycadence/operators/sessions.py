"""Sessions and running event counts per user, for stored events.

Both work on ``event_ts`` and ``event_id`` as the order of a user's events, and
both stay parallel when one user holds a large part of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import RESET_TYPES, SESSION_START, TEST_COMPLETE
from ..sources.storage import ensure_checkpoint_dir
from .skew import FLOOR, SHARE, heavy_limit, scatter


def _moment() -> Column:
    return F.struct("event_ts", "event_id")


def session_tracker(
    events: DataFrame, floor: int = FLOOR, share: int = SHARE
) -> DataFrame:
    """The current session of every user: start, end, number of events.

    The last ``SESSION_START`` opens the session and is its first event; the
    last ``TEST_COMPLETE`` after it sets the end. Events before any start count
    for nothing.
    """
    return _since_start(events, floor, share, started_only=True).drop("started")


def session_changes(
    events: DataFrame, floor: int = FLOOR, share: int = SHARE
) -> DataFrame:
    """What some events, such as a micro-batch, do to each user's session.

    ``started`` users begin a new session here. For the others the count and the
    end are to be added to the session they have, if any.
    """
    return _since_start(events, floor, share, started_only=False)


def sessions_from_log(log: DataFrame) -> DataFrame:
    """Current sessions from the ``session_changes`` of numbered batches.

    At most one row per user and batch, so no user is large here.
    """
    opened = log.filter("started").groupBy("userId").agg(F.max("batch_id").alias("opened"))
    ended = F.when(F.col("end_time").isNotNull(), F.struct("batch_id", "end_time"))
    first = F.col("batch_id") == F.col("opened")
    return (
        log.join(opened, "userId")
        .filter(F.col("batch_id") >= F.col("opened"))
        .groupBy("userId")
        .agg(
            F.max(F.when(first, F.col("start_time"))).alias("start_time"),
            F.max(ended).getField("end_time").alias("end_time"),
            F.sum("events_count").alias("events_count"),
        )
    )


def _since_start(events: DataFrame, floor: int, share: int, started_only: bool) -> DataFrame:
    """Count and end of each user's events from the last start on, if there is one.

    Two passes, both combining on the map side: a profile per user (rows, last
    start), then the events from that start on. The rows of a heavy user are
    spread over salts, with the user's one start row repeated for each salt, so
    no task gets more than about ``heavy_limit`` rows.
    """
    marks = events.filter(F.col("userId").isNotNull()).select(
        "userId", "event_ts", "event_id", "eventType"
    )
    profile = marks.groupBy("userId").agg(
        F.count("*").alias("n"),
        F.max(F.when(F.col("eventType") == SESSION_START, _moment())).alias("start"),
    )
    limit = heavy_limit(profile, floor=floor, share=share)
    sized = profile.withColumn(
        "salts", F.when(F.col("n") > limit, F.ceil(F.col("n") / limit)).otherwise(1)
    )

    heavy = sized.filter(F.col("salts") > 1).select(
        "userId", "salts", F.col("start").isNotNull().alias("has_start")
    )
    spread = marks.join(F.broadcast(heavy), "userId", "left")
    starts = sized
    if started_only:
        spread = spread.filter(F.coalesce("has_start", F.lit(True)))
        starts = starts.filter(F.col("start").isNotNull())
    salted = spread.select(
        "userId",
        F.when(F.col("salts") > 1, F.pmod(scatter("event_id"), F.col("salts")))
        .otherwise(0)
        .alias("salt"),
        _moment().alias("moment"),
        F.when(F.col("eventType") == TEST_COMPLETE, F.col("event_ts")).alias("completed"),
    )
    starts = starts.select(
        "userId",
        "start",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
    )
    return (
        salted.join(starts, ["userId", "salt"])
        .filter(F.col("start").isNull() | (F.col("moment") >= F.col("start")))
        .groupBy(
            "userId",
            F.col("start").isNotNull().alias("started"),
            F.col("start.event_ts").alias("start_time"),
        )
        .agg(F.max("completed").alias("end_time"), F.count("*").alias("events_count"))
    )


def _placed(events: DataFrame, *keys: str) -> DataFrame:
    """Row number and row number of the last reset, within ``keys``; one sort."""
    order = Window.partitionBy(*keys).orderBy("event_ts", "event_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reset = F.col("eventType").isin(*RESET_TYPES)
    return events.withColumn("place", F.row_number().over(order).cast("long")).withColumn(
        "reset_place", F.max(F.when(reset, F.col("place"))).over(so_far)
    )


def _since_reset(before: Column) -> Column:
    return F.when(
        F.col("reset_place").isNotNull(), F.col("place") - F.col("reset_place") + 1
    ).otherwise(F.col("place") + before)


def event_counter(
    events: DataFrame, floor: int = FLOOR, share: int = SHARE
) -> DataFrame:
    """Adds ``event_no``, the running number of each event since the last reset.

    ``SESSION_START`` and ``TEST_RESTART`` reset the count and are number one.

    Normally one window per user. Users that are too large for one task, if a
    counting pass finds any, are numbered in range slices instead, see
    ``_count_in_slices``.
    """
    profile = events.groupBy("userId").agg(F.count("*").alias("n"))
    heavy = profile.filter(F.col("n") > heavy_limit(profile, floor=floor, share=share))
    columns = [*events.columns, "event_no"]
    # At most `share` rows, a bound that does not depend on the data. Written
    # once, so that both sides below split the users the same way.
    ensure_checkpoint_dir(events.sparkSession)
    heavy = heavy.select(F.col("userId").alias("heavy_user"), "n").checkpoint()
    heavy_rows = heavy.agg(F.sum("n")).first()[0]
    if heavy_rows is None:
        plain, sliced = events, None
    else:
        same = F.col("userId").eqNullSafe(F.col("heavy_user"))
        usual = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slices = max(usual, heavy_rows // FLOOR + 1)
        plain = events.join(F.broadcast(heavy), same, "left_anti")
        large = events.join(F.broadcast(heavy), same, "left_semi")
        sliced = _count_in_slices(large, slices)
    counted = (
        _placed(plain, "userId")
        .withColumn("event_no", _since_reset(F.lit(0)))
        .select(*columns)
    )
    return counted if sliced is None else counted.unionByName(sliced.select(*columns))


def _count_in_slices(events: DataFrame, slices: int) -> DataFrame:
    """The running count as a two-level prefix sum.

    Range partitioning by user and order cuts even a single user into slices of
    equal size. Each slice is numbered on its own; what a slice hands to the
    next one of the same user is a single number, summed up over the slices.
    The sliced rows are checkpointed: slice borders come from a sample, and the
    rows and their slice summaries must see the same borders.
    """
    ordered = events.withColumn("copy", F.spark_partition_id()).repartitionByRange(
        slices, "userId", "event_ts", "event_id", "copy"
    )
    sliced = ordered.withColumn("slice", F.spark_partition_id()).drop("copy").checkpoint()
    placed = _placed(sliced, "userId", "slice")

    # Events since the last reset at the end of each slice, one row per slice and user.
    ends = placed.groupBy("userId", "slice").agg(
        F.count("*").alias("rows"), F.max("reset_place").alias("last_reset")
    )
    by_slice = Window.partitionBy("userId").orderBy("slice")
    handed_on = F.coalesce(F.col("rows") - F.col("last_reset") + 1, F.col("rows"))
    stretch = (
        Window.partitionBy("userId", "stretch")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = (
        ends.withColumn("stretch", F.count("last_reset").over(by_slice))
        .withColumn("total", F.sum(handed_on).over(stretch))
        .select(
            F.col("userId").alias("slice_user"),
            F.col("slice").alias("slice_no"),
            F.coalesce(F.lag("total").over(by_slice), F.lit(0)).alias("before"),
        )
    )
    here = F.col("userId").eqNullSafe(F.col("slice_user")) & (
        F.col("slice") == F.col("slice_no")
    )
    return placed.join(carried, here, "left").withColumn(
        "event_no", _since_reset(F.col("before"))
    )
