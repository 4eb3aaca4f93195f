"""Stored event logs as batch or as a stream, in place of a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import Files


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text log with one JSON event per line, as records."""
    return spark.read.text(path).selectExpr("CAST(value AS BINARY) AS value")


def replay_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """``read_lines`` as a stream."""
    reader = _paced(spark.readStream, files_per_trigger)
    return reader.text(path).selectExpr("CAST(value AS BINARY) AS value")


def replay_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files as a stream, oldest first.

    A stream source wants a folder. Written as a glob, the path may also be one
    single file.
    """
    if schema is None:
        schema = spark.read.parquet(path).schema
    reader = _paced(spark.readStream.schema(schema), files_per_trigger)
    return reader.parquet(_as_glob(path))


#: Rows of one file of a replay: a file is read by one task.
FILE_ROWS = 50_000
#: Files of one part; Spark keeps a list of 10,000 files to come and may cut a batch there.
MOST_FILES = 1_000


def files_for(rows: DataFrame, parts: int) -> int:
    """Files for each of ``parts`` equal parts of these rows; counts them."""
    return min(MOST_FILES, max(1, -(-rows.count() // (parts * FILE_ROWS))))


def write_in_parts(
    rows: DataFrame, order: str, parts: int, folder: str, files: int = 1
) -> str:
    """Stored rows as files in ascending ``order``, for a replay in several batches.

    Borders are quantiles; each range is written after the one before it, which is the
    order in which a stream takes files up. Rows without a value come first. Every range
    is ``files`` files, empty ones if there are too few rows, so that a stream that takes
    up ``files`` of them at a time has a range in each batch.
    """
    store, spark = Files(rows.sparkSession, folder), rows.sparkSession
    empty, written = spark.createDataFrame([], rows.schema).coalesce(1), 0
    shares = [k / parts for k in range(1, parts)]
    borders = rows.agg(F.percentile_approx(order, shares)).first()[0] or []
    value, low = F.col(order), None
    for high in [*sorted(set(borders)), None]:
        part = rows
        if low is not None:
            part = part.filter(value > low)
        if high is not None:
            part = part.filter((value <= high) if low is not None else value.isNull() | (value <= high))
        part = part.repartition(files) if files > 1 else part.coalesce(1)
        part.write.mode("append").option("maxRecordsPerFile", 0).parquet(folder)
        written += files
        for _ in range(written - sum(name.startswith("part-") for name in store.names(""))):
            empty.write.mode("append").parquet(folder)
        low = high
    return folder


def _paced(reader, files_per_trigger: int | None):
    if files_per_trigger is None:
        return reader
    return reader.option("maxFilesPerTrigger", files_per_trigger)


def _as_glob(path: str) -> str:
    if any(sign in path for sign in "*?[{"):
        return path
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"
