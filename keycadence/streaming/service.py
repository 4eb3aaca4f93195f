"""The service: one stream of records kept as results that can be asked for any time.

Each micro-batch is read and parsed once. Records that give no event go to a log. The
keystrokes are summed up per user, added to what the keyed store knows of these users,
and written as the changed users' rows. Population and leaderboard follow from the
changed users alone and stand in the store's manifest. Nothing else is kept: results,
ranks and stored records are computed from the store when they are read, so a trigger
neither writes nor ranks users that had no events.

A batch that runs again, after a failure or a restart, starts from the version before
it and replaces what it had written. The stream itself has no state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import tenths
from ..operators.board import board_after, first_places, rankable
from ..operators.events import decode_values, service_events, with_non_empty_user
from ..operators.moments import (
    Population,
    counted_average,
    key_moments,
    merged_moments,
    population_after,
    population_of,
    stats_from_moments,
)
from ..operators.ranking import encode_results, result_records
from ..operators.serving import (
    NO_NUMBER,
    lookup_present,
    lookup_with_default,
    stored_results,
)
from ..schema import KEYSTROKE
from ..sources.keyed_store import VERSION, KeyedStore, Manifest
from ..sources.storage import write_batch
from .sinks import BatchWriter, every, start_batches

NO_BOARD = {"candidates": [], "floor": None}


def user_store(spark: SparkSession, folder: str, **how: int) -> KeyedStore:
    return KeyedStore(spark, f"{folder}/users", **how)


def unreadable_writer(folder: str) -> BatchWriter:
    """Logs the records of a batch of ``service_events`` that give no event."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bad = batch.filter(F.col("reason").isNotNull()).select("json", "reason")
        if not bad.isEmpty():
            write_batch(bad, f"{folder}/unreadable", batch_id)

    return write


def result_writer(folder: str, **how: int) -> BatchWriter:
    """Adds the keystrokes of a batch of ``service_events`` to the store."""

    def write(batch: DataFrame, batch_id: int) -> None:
        typed = batch.filter((F.col("eventType") == KEYSTROKE) & F.col("wpm").isNotNull())
        apply_changes(user_store(batch.sparkSession, folder, **how), key_moments(typed), batch_id)

    return write


def apply_changes(store: KeyedStore, fresh: DataFrame, version: int) -> Manifest | None:
    """A new version with ``fresh`` moments added to those of the version before."""
    before = store.manifest(below=version)
    fresh = fresh.persist()
    try:
        users = fresh.count()
        if not users:
            return None
        known = store.lookup(fresh, before) if before else None
        merged = merged_moments(fresh, known).withColumn(VERSION, F.lit(version).cast("long"))
        run = store.write_run(merged, version, users)
    finally:
        fresh.unpersist()
    changed = store.run_rows(run, merged.schema)
    older = before.runs if before else []
    now = Manifest(version, [*older, run], merged.schema.jsonValue())
    population = Population(*before.more["population"]) if before else Population()
    population = population_after(population, changed) or population_of(store.rows(now))
    board = board_after(
        before.more["board"] if before else NO_BOARD,
        _board_rows(changed),
        lambda: rankable(stored_results(_records(store.rows(now), population))),
    )
    more = {"population": list(population), "board": board}
    return store.commit(version, before, run, merged.schema, more)


def _board_rows(changed: DataFrame) -> DataFrame:
    accuracy = F.when(F.col("n_accuracy") > 0, F.col("accuracy") / F.col("n_accuracy"))
    return with_non_empty_user(changed).select(
        F.col("userId").alias("username"),
        tenths(counted_average()).alias("avg_wpm"),
        F.coalesce(tenths(accuracy), F.lit(NO_NUMBER).cast("double")).alias("avg_accuracy"),
    )


def _records(moments: DataFrame, population: Population, at: Column | None = None) -> DataFrame:
    known = (population.mean, population.spread)
    return result_records(stats_from_moments(moments), at, known)


def start_service(
    records: DataFrame, folder: str, trigger: dict | None = None, *more: BatchWriter, **how: int
) -> StreamingQuery:
    """Run the service over a stream of records, below the durable ``folder``.

    One query with one read of the source; ``more`` writers get the same batches.
    """
    return start_batches(
        service_events(decode_values(records)),
        [unreadable_writer(folder), result_writer(folder, **how), *more],
        f"{folder}/checkpoints/service",
        trigger or every(15),
        mode="append",
    )


# Reading


def read_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of every user, as of the newest version."""
    return stats_from_moments(user_store(spark, folder).rows())


def read_population(spark: SparkSession, folder: str) -> Population:
    """Users, mean and second moment of their averages; reads the manifest only."""
    manifest = user_store(spark, folder).manifest()
    return Population(*manifest.more["population"]) if manifest else Population()


def read_results(spark: SparkSession, folder: str, at: Column | None = None) -> DataFrame:
    """Result records of every user, ranked against the population of the same version."""
    store = user_store(spark, folder)
    manifest = store.manifest()
    population = Population(*manifest.more["population"])
    return _records(store.rows(manifest), population, at)


def read_result_json(spark: SparkSession, folder: str, at: Column | None = None) -> DataFrame:
    """Result records as one JSON text each, keyed by user."""
    return encode_results(read_results(spark, folder, at))


def read_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    """The first places; reads the manifest only."""
    manifest = user_store(spark, folder).manifest()
    return first_places(spark, manifest.more["board"] if manifest else NO_BOARD)


def requested_results(
    spark: SparkSession, folder: str, requested: DataFrame, at: Column | None = None
) -> DataFrame:
    """Stored records of those ``requested`` users that have any; reads their buckets."""
    store = user_store(spark, folder)
    manifest = store.manifest()
    population = Population(*manifest.more["population"])
    return stored_results(_records(store.lookup(requested, manifest), population, at), at)


def lookup_stored(
    spark: SparkSession,
    folder: str,
    requested: DataFrame,
    at: Column | None = None,
    with_default: bool = True,
) -> DataFrame:
    """A record for each requested user, or only for those that have one."""
    found = requested_results(spark, folder, requested.select("userId"), at)
    return (lookup_with_default if with_default else lookup_present)(requested, found)
