"""The running number of every event since the user's last reset, over a stream.

Within a micro-batch the batch operator numbers the events, with its way for users
that one task cannot hold. Between micro-batches a user is one number in a keyed
store: the events since the last reset so far. It is added to those events of the next
batch that come before a reset there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sessions import event_counter
from ..schema import RESET_TYPES
from ..sources.keyed_store import VERSION, KeyedStore
from ..sources.storage import read_log, write_batch
from .sinks import BatchWriter, every, start_batches


def _moment():
    return F.struct("event_ts", "event_id")


def with_carried(marks: DataFrame, known: DataFrame | None, **how: int) -> DataFrame:
    """``event_counter`` of a batch, going on from the numbers ``known`` by user."""
    numbered = event_counter(marks, **how)
    if known is None:
        return numbered
    reset = F.when(F.col("eventType").isin(*RESET_TYPES), _moment())
    heads = marks.groupBy("userId").agg(F.min(reset).alias("reset"))
    carried = known.select(F.col("userId").alias("known user"), "since")
    heads = heads.join(carried, F.col("userId").eqNullSafe(F.col("known user"))).select(
        "known user", "reset", "since"
    )
    joined = numbered.join(heads, F.col("userId").eqNullSafe(F.col("known user")), "left")
    open_yet = F.col("reset").isNull() | (_moment() < F.col("reset"))
    more = F.coalesce(F.when(open_yet, F.col("since")), F.lit(0))
    return joined.withColumn("event_no", F.col("event_no") + more).select(*numbered.columns)


def counter_writer(folder: str, **how: int) -> BatchWriter:
    """Numbers a batch of events into the log ``counted`` and keeps the store ``since``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = KeyedStore(spark, f"{folder}/since")
        before = store.manifest(below=batch_id)
        users = batch.select("userId").distinct()
        known = store.lookup(users, before) if before else None
        write_batch(with_carried(batch, known, **how), f"{folder}/counted", batch_id)
        counted = spark.read.schema(_log_schema(batch)).parquet(
            f"{folder}/counted/batch_id={batch_id}"
        )
        last = F.max(F.struct(_moment().alias("moment"), "event_no"))
        since = counted.groupBy("userId").agg(last["event_no"].alias("since"))
        since = since.withColumn(VERSION, F.lit(batch_id).cast("long"))
        run = store.write_run(since, batch_id, users.count())
        store.commit(batch_id, before, run, since.schema, {})

    return write


def _log_schema(batch: DataFrame):
    return batch.withColumn("event_no", F.lit(0).cast("long")).schema


def start_event_counter(
    marks: DataFrame, folder: str, trigger: dict | None = None, **how: int
) -> StreamingQuery:
    """Number the events of a stream of ``session_marks`` below the durable ``folder``."""
    return start_batches(
        marks, [counter_writer(folder, **how)], f"{folder}/checkpoints/counter",
        trigger or every(15), mode="append",
    )


def read_counted(spark: SparkSession, folder: str) -> DataFrame:
    """All numbered events so far."""
    return read_log(spark, f"{folder}/counted").drop("batch_id")
