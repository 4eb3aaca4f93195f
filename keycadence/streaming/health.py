"""State of a running service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.serving import health_counts


def query_health(query: StreamingQuery) -> dict:
    """Progress of one query: alive, last batch, rows read, rate, state rows."""
    progress = query.lastProgress or {}
    return {
        "active": query.isActive,
        "failed": query.exception() is not None,
        "state": query_state(query),
        "batch_id": progress["batchId"] if progress else None,
        "input_rows": progress["numInputRows"] if progress else 0,
        "rows_per_second": progress["processedRowsPerSecond"] if progress else 0.0,
        "state_rows": sum(s["numRowsTotal"] for s in progress["stateOperators"])
        if progress
        else 0,
    }


def query_state(query: StreamingQuery) -> str:
    """``running``, ``failed``, or ``ended``: stopped, or done with its input."""
    if query.exception() is not None:
        return "failed"
    return "running" if query.isActive else "ended"


def health(sessions: DataFrame, stored: DataFrame, *queries: StreamingQuery) -> DataFrame:
    """One row: overall status, source connection and the two counts.

    The source counts as connected while every query runs. ``stored`` has a row
    per user with a stored result.
    """
    states = {query_state(q) for q in queries}
    status = "failing" if "failed" in states else "ended" if "ended" in states else "healthy"
    return health_counts(sessions, stored).select(
        F.lit(status).alias("status"),
        F.lit(status == "healthy").alias("source_connected"),
        "active_sessions",
        "spark_analytics_count",
    )
