import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from period_etl.session import local_session, scratch_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="period_etl-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared checkpoint folder."""
    return scratch_dir(spark, "test")


TRIPS = [
    (1, datetime(2025, 1, 1, 0, 0, 0)),
    (2, datetime(2025, 1, 31, 23, 59, 59, 999999)),
    (3, datetime(2025, 2, 1, 0, 0, 0)),
    (4, datetime(2024, 12, 31, 23, 59, 59)),
    (5, datetime(2024, 1, 15, 10, 0, 0)),
    (6, None),
    (7, datetime(2025, 1, 1, 18, 0, 0)),
]


@pytest.fixture()
def trips(spark):
    return spark.createDataFrame(TRIPS, "id bigint, ts timestamp_ntz")
