"""The shared folder comes from the cluster; only a local session may make its own."""

import pytest
from pyspark.errors import AnalysisException

from wardlake.session import scratch_path, shared_dir
from wardlake.sources.messages import read_stream, write_messages


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings = {k.replace("__", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_folder_named_by_the_cluster():
    session = Session(spark__checkpoint__dir="hdfs://lake/tmp/", spark__master="yarn")
    assert shared_dir(session) == "hdfs://lake/tmp"
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first != second and first.startswith("hdfs://lake/tmp/wardlake/x-")


def test_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(spark__master="spark://host:7077"))


def test_local_session_makes_one_folder():
    session = Session(spark__master="local[2]")
    assert shared_dir(session) == shared_dir(session)


def test_kafka_needs_its_connector(spark):
    options = {"kafka.bootstrap.servers": "broker:9092", "subscribe": "discharges"}
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_stream(spark, **options)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        write_messages(spark.createDataFrame([("k", "v")], "key string, value string"), "discharges", **{
            "kafka.bootstrap.servers": "broker:9092"
        })
