import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("scratch")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def text(spark):
    """Build a frame of text columns from rows of strings."""

    def build(names, rows):
        return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))

    return build


@pytest.fixture
def clock():
    from feedwright.functions.dates import RunClock

    return RunClock(dt.datetime(2017, 9, 20, 10, 0, 0))


def rows(df):
    """Rows as sorted tuples, copies kept."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def sorted_rows():
    return rows
