import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from condmon.session import local_session

    s = local_session(4, shuffle_partitions=4, app="condmon-tests")
    yield s
    s.stop()


def wide(spark, signals: dict, test_set: str = "t"):
    """Rows ``(test_set, file, b1..b4)`` with the same signal on all four
    channels; ``signals`` maps file -> list of samples (None = NULL)."""
    rows = [(test_set, f, x, x, x, x) for f, xs in signals.items() for x in xs]
    return spark.createDataFrame(rows, "test_set string, file string, b1 double, b2 double, b3 double, b4 double")
