"""Session settings for cluster and test runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings every run wants. Shuffle width is not fixed here: AQE coalesces a
#: generous initial width in batch, and a stateful stream keeps the width it
#: was first started with, so the cluster chooses it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: State kept on executor disk instead of heap, with incremental checkpoints.
#: For streams with many users.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str = "keycadence", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with ``DEFAULTS``; pass further settings as ``**{"spark.x": "y"}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: event times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
