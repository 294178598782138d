import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import get_spark

    s = get_spark(cores="*", shuffle_partitions=8)
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
