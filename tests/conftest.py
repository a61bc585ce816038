import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from moorage.session import scratch_path, session  # noqa: E402
from moorage.sources.store import SnapshotStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests", spark__master="local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def store(spark):
    return SnapshotStore(spark, scratch_path(spark, "test-store"))


def rows(frame, *columns):
    """Rows as sorted tuples."""
    frame = frame.select(*columns) if columns else frame
    return sorted(tuple(row) for row in frame.collect())
