import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from lexispan.session import get_session

    s = get_session("local[4]", shuffle_partitions=4, app_name="lexispan-tests")
    yield s


def docs(spark, rows):
    """(file_path, text) DataFrame from Python tuples."""
    return spark.createDataFrame(rows, "file_path string, text string")
