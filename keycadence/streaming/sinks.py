"""Starting streaming queries: previews, batch callbacks, logs, stores and snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import result_records
from ..operators.serving import leaderboard, stored_results
from ..sources.storage import write_batch, write_snapshot

BatchWriter = Callable[[DataFrame, int], None]

#: Run until the input seen at the start is used up, then stop.
ALL_AVAILABLE = {"availableNow": True}


def every(seconds: int) -> dict[str, str]:
    """A processing-time trigger."""
    return {"processingTime": f"{seconds} seconds"}


def preview_writer(
    rows: int = 20, shape: Callable[[DataFrame], DataFrame] | None = None
) -> BatchWriter:
    """Prints a preview of each batch: at most ``rows`` rows, limited on the executors.

    Nothing is dropped from the results; those are what the other writers store.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        shown = shape(batch) if shape else batch
        print(f"batch {batch_id}")
        shown.limit(rows).show(rows, truncate=False)

    return write


def start_batches(
    rows: DataFrame,
    writers: Sequence[BatchWriter],
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "complete",
) -> StreamingQuery:
    """Hand each micro-batch to every writer, from one source read and one state.

    The batch is persisted meanwhile: each action on it would otherwise run the
    micro-batch again, state included. A failing writer fails the query, and
    the batch runs again after a restart, so writers must be repeatable.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                for write in writers:
                    write(batch, batch_id)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or every(15)))
        .start()
    )


def snapshot_writer(folder: str, shape: Callable[[DataFrame], DataFrame] | None = None):
    """Keeps only the newest batch, shaped by a DataFrame function."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_snapshot(shape(batch) if shape else batch, folder)

    return write


def log_writer(folder: str, shape: Callable[[DataFrame], DataFrame] | None = None):
    """Keeps every batch in its own partition of a log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(shape(batch) if shape else batch, folder, batch_id)

    return write


def leaderboard_writer(folder: str) -> BatchWriter:
    """Stores the leaderboard of a complete-mode batch."""
    return snapshot_writer(
        folder, lambda stats: leaderboard(stored_results(result_records(stats)))
    )


def await_any(spark: SparkSession) -> None:
    """Block until one of the session's queries ends; its failure is raised here."""
    spark.streams.awaitAnyTermination()
