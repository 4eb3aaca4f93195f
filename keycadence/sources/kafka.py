"""Kafka in and out. Needs the Spark Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the topic of the event stream.
TOPIC = "typing-events"
#: Largest accepted request of the producer, in bytes (fixed value).
MAX_REQUEST_BYTES = 10_485_760
#: A policy that passes over lost records, 50 at a time.
LENIENT = {"fail_on_data_loss": False, "max_offsets_per_trigger": 50}


def source_options(
    servers: str,
    topic: str = TOPIC,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the stream source.

    By default nothing is lost silently: expired records fail the query, and a
    micro-batch takes all there is. ``max_offsets_per_trigger`` bounds a
    micro-batch; a limit below the arrival rate falls behind for good.
    ``min_partitions`` lets more tasks read than the topic has partitions.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.max.request.size": str(MAX_REQUEST_BYTES),
    }


def read_topic(spark: SparkSession, servers: str, **policy) -> DataFrame:
    """Streaming records of the event topic, ``value`` as bytes."""
    options = source_options(servers, **policy)
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(encoded: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send ``key`` and ``value`` of a batch frame to a topic."""
    encoded.write.format("kafka").options(**sink_options(servers, topic)).save()
