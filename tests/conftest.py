import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from check import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SMALL


@pytest.fixture
def ratings_of(spark):
    """Ratings from (user, item, rating, timestamp) tuples."""

    def build(rows, partitions=3):
        frame = spark.createDataFrame(rows, "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT")
        return frame.repartition(partitions)

    return build


@pytest.fixture
def rows_of():
    """Rows of a frame as a sorted list of tuples."""
    return lambda frame: sorted((tuple(r) for r in frame.collect()), key=repr)
