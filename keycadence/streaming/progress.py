"""What streaming queries report about themselves, kept beyond their session."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.files import Files

SHAPE = (
    "kind string, query string, run string, name string, at string, batch_id long, "
    "input_rows long, rows_per_second double, state_rows long, "
    "late_rows long, error string"
)


class ProgressLog(StreamingQueryListener):
    """Writes start, progress and end of every query of a session below a folder.

    Small files of JSON lines: a start and an end are written at once, progress after
    every ``lines`` reports. A session that dies leaves a start without an end, and a
    query started again has a run of its own, so both show in the log.
    """

    def __init__(self, spark: SparkSession, folder: str, lines: int = 1):
        self._files, self._lines = Files(spark, f"{folder}/progress"), lines
        self._session, self._number, self._waiting = uuid.uuid4().hex[:12], 0, []

    def _add(self, event, kind: str, now: bool, **more) -> None:
        line = {"kind": kind, "query": str(event.id), "run": str(event.runId), **more}
        self._waiting.append(json.dumps(line))
        if now or len(self._waiting) >= self._lines:
            name = f"{self._session}-{self._number:09d}.json"
            self._files.write(name, "\n".join(self._waiting) + "\n")
            self._number, self._waiting = self._number + 1, []

    def onQueryStarted(self, event) -> None:
        self._add(event, "start", True, name=event.name, at=event.timestamp)

    def onQueryProgress(self, event) -> None:
        found = event.progress
        self._add(
            found, "progress", False, name=found.name, at=found.timestamp,
            batch_id=found.batchId, input_rows=found.numInputRows,
            rows_per_second=found.processedRowsPerSecond,
            state_rows=sum(s.numRowsTotal for s in found.stateOperators),
            late_rows=sum(s.numRowsDroppedByWatermark for s in found.stateOperators),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._add(event, "end", True, error=event.exception)


def log_progress(spark: SparkSession, folder: str, lines: int = 1) -> ProgressLog:
    """Keep the reports of all queries started from now on."""
    listener = ProgressLog(spark, folder, lines)
    spark.streams.addListener(listener)
    return listener


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SHAPE).json(f"{folder}/progress")


def runs(reports: DataFrame) -> DataFrame:
    """A row for each run of a query: when, how far, how much, and how it ended.

    ``state`` is ``failed`` or ``ended`` if its end was reported; ``restarted`` if it was
    not and a later run of the query is known; else ``open``, running or lost with its
    session, which ``last_report`` tells.
    """
    def where(kind: str, value: str | Column) -> Column:
        return F.when(F.col("kind") == kind, F.col(value) if isinstance(value, str) else value)

    summed = reports.groupBy("query", "run").agg(
        F.max("name").alias("name"),
        F.min(where("start", "at")).alias("started"),
        F.max("at").alias("last_report"),
        F.max("batch_id").alias("last_batch"),
        F.coalesce(F.sum(where("progress", "input_rows")), F.lit(0)).alias("input_rows"),
        F.coalesce(F.sum("late_rows"), F.lit(0)).alias("late_rows"),
        F.count(where("end", "kind")).alias("ends"),
        F.max(where("end", "error")).alias("error"),
    )
    later = F.lead("run").over(Window.partitionBy("query").orderBy("started", "run"))
    state = (
        F.when((F.col("ends") > 0) & F.col("error").isNotNull(), "failed")
        .when(F.col("ends") > 0, "ended")
        .when(F.col("later").isNotNull(), "restarted")
        .otherwise("open")
    )
    return summed.withColumn("later", later).withColumn("state", state).drop("ends", "later")


def logged_health(reports: DataFrame) -> DataFrame:
    """One row over the newest run of every query: counts by state, and the status."""
    newest = runs(reports).withColumn(
        "place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("started"), F.desc("run")))
    )
    count = lambda state: F.count_if(F.col("state") == state)
    return newest.filter("place = 1").agg(
        F.count("*").alias("queries"),
        count("open").alias("open"),
        count("ended").alias("ended"),
        count("failed").alias("failed"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
    ).withColumn(
        "status",
        F.when(F.col("failed") > 0, "failing").when(F.col("ended") > 0, "ended").otherwise("healthy"),
    )
