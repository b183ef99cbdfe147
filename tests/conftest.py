import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("LARDER_DRIVER_MEMORY", "6g")
    from larder.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8)
    yield s
