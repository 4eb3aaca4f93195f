"""Intermediate tables in the shared folder, and small expression helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import run_folder

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(rows: DataFrame, label: str) -> DataFrame:
    """Write rows once below ``spark.checkpoint.dir`` and read them back.

    Cuts lineage: an executor lost later costs a read of the stored files and no
    recomputation. Compressed, so it takes less disk than a checkpoint. Shuffle
    files behind the rows are of no more use then; Spark is told to remove them.
    """
    spark = rows.sparkSession
    folder = run_folder(spark, label)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(folder)
    finally:
        spark.conf.set(CLEAN_UP, before)
    stored = spark.read.schema(rows.schema).parquet(folder)
    stored.folder = folder
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read any more."""
    for rows in stored:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(rows.folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(rows: DataFrame) -> DataFrame:
    """One side of a join that is to be shuffled and sorted, and never broadcast.

    Spark takes a table's size from its compressed files and from fixed sizes of types:
    an array counts as one element, and rows that Python or an explode makes out of one
    row count as one. A table that grows with the input can so seem small enough to be
    gathered in the driver.
    """
    return rows.hint("merge")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def text_of(column: str = "text") -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def parts_for(rows: DataFrame, each: int) -> int:
    """How many parts of about ``each`` rows these rows make; counts them."""
    return max(1, -(-rows.count() // each))
