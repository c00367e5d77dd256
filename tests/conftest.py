import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rules(spark):
    from tallyloom.sources.rules import parse_rules, usable

    def make(*lines):
        frame = spark.createDataFrame([(line,) for line in lines], "line string")
        return usable(parse_rules(frame)).drop("line")

    return make


@pytest.fixture
def events(spark):
    """Events from (id, table, ms, fields) tuples."""
    from pyspark.sql import functions as F

    def make(*rows):
        frame = spark.createDataFrame(
            list(rows), "event_id bigint, table_name string, event_ms bigint, fields map<string,string>"
        )
        return frame.withColumn("event_time", F.timestamp_millis("event_ms"))

    return make
