import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labflow.session import build_session  # noqa: E402
from labflow.sinks.commit import Zones  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "tests",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def zones(tmp_path):
    return Zones.below(str(tmp_path))


@pytest.fixture
def put(zones):
    """Write a text file into a zone."""

    def write(zone, name, text):
        folder = getattr(zones, zone)
        os.makedirs(folder, exist_ok=True)
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)

    return write


@pytest.fixture
def feed(spark):
    """Feed rows from tuples (sample_id, test_date, result, viral_load, source_file, row_pos)."""

    def make(rows):
        return spark.createDataFrame(
            rows,
            "sample_id string, test_date string, result string, viral_load string, source_file string, row_pos bigint",
        )

    return make


@pytest.fixture
def records(spark):
    """Valid records from tuples (sample_id, 'YYYY-MM-DD', result, viral_load, source_file, row_pos)."""

    def make(rows):
        text = spark.createDataFrame(
            rows,
            "sample_id string, test_date string, result string, viral_load bigint, source_file string, row_pos bigint",
        )
        return text.withColumn("test_date", text.test_date.cast("date"))

    return make


def rows(df, *columns):
    """Rows as sorted tuples, dates as text."""
    got = [tuple(str(v) if hasattr(v, "isoformat") else v for v in r) for r in df.select(*columns).collect()]
    return sorted(got, key=str)
