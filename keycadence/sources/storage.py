"""Shared folders, and logs of micro-batch output written into them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Without the setting a local session gets a temporary folder; a cluster
    session is refused, since a folder of one machine is lost with it.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    known = spark.sparkContext.getCheckpointDir()
    return known.rstrip("/") if known else tempfile.mkdtemp(prefix="keycadence-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; keeps a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared one, never handed out twice."""
    return f"{shared_folder(spark)}/keycadence/{label}-{uuid.uuid4().hex}"


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    """Write one micro-batch into a log; writing it again replaces it.

    A stream may run a batch twice after a failure. Its own sub-folder per batch
    makes that harmless.
    """
    rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch of a log, with ``batch_id`` as a column."""
    log = spark.read.option("basePath", folder).parquet(folder)
    return log.withColumn("batch_id", F.col("batch_id").cast("long"))


def read_last_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the newest batch; older ones are pruned as partitions."""
    log = read_log(spark, folder)
    newest = log.agg(F.max("batch_id")).scalar()
    return log.filter(F.col("batch_id") == newest)


def write_version(rows: DataFrame, folder: str, version: int, keep: int = 3) -> None:
    """Write one version of a stored list beside the earlier ones; the last ``keep`` stay.

    The version is named in ``complete`` only after all of its files are there,
    so that a reader never meets a missing or half-written list.
    """
    rows.write.mode("overwrite").parquet(f"{folder}/version={version}")
    files = Files(rows.sparkSession, folder)
    files.write(f"complete/{version}", "")
    older = sorted(v for v in _complete(files) if v <= version)[:-keep]
    for old in older:
        files.delete(f"complete/{old}")
        files.delete(f"version={old}")


def _complete(files: Files) -> list[int]:
    return [int(name) for name in files.names("complete") if name.isdigit()]


def newest_version(spark: SparkSession, folder: str, below: int | None = None) -> int | None:
    """The newest complete version, older than ``below`` if given; None if there is none."""
    known = [v for v in _complete(Files(spark, folder)) if below is None or v < below]
    return max(known, default=None)


def read_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A version of a stored list, the newest complete one by default."""
    if version is None:
        version = newest_version(spark, folder)
    return spark.read.parquet(f"{folder}/version={version}")


def write_snapshot(rows: DataFrame, folder: str) -> None:
    """Replace a whole stored list, such as the leaderboard."""
    rows.write.mode("overwrite").parquet(folder)
