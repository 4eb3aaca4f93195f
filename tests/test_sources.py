"""Option builders and folder rules."""

import pytest

from keycadence.session import ROCKSDB_STATE
from keycadence.sources import kafka, replay, storage


def test_kafka_source_options():
    options = kafka.source_options("broker:9092", **kafka.LENIENT, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "typing-events",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "50",
        "minPartitions": "64",
    }
    careful = kafka.source_options("b")
    assert careful["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in careful


def test_kafka_sink_options():
    assert kafka.sink_options("b", "t") == {
        "kafka.bootstrap.servers": "b", "topic": "t", "kafka.max.request.size": "10485760"}


def test_glob_form_of_a_path():
    assert replay._as_glob("/x/events.parquet") == "/x/events.parque[t]"
    assert replay._as_glob("/x/events/") == "/x/event[s]"
    assert replay._as_glob("/x/*.parquet") == "/x/*.parquet"


class _Session:
    def __init__(self, folder, master):
        self.conf = {} if folder is None else {storage.CHECKPOINT_SETTING: folder}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_clusters():
    assert storage.shared_folder(_Session("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        storage.shared_folder(_Session(None, "yarn"))
    assert storage.shared_folder(_Session(None, "local[2]"))


def test_run_folders_differ(spark):
    one, two = storage.run_folder(spark, "x"), storage.run_folder(spark, "x")
    assert one != two and one.startswith(storage.shared_folder(spark))


def test_rocksdb_state_is_opt_in():
    assert any("RocksDB" in v for v in ROCKSDB_STATE.values())
