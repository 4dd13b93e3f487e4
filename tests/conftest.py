import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flightlake.session import checkpoint_root, get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", shuffle_partitions=4)
    checkpoint_root(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="flightlake-test-")
