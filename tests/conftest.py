import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roaskit.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("roaskit-tests", cpus=4, shuffle_partitions=4)
    yield s
    s.stop()
