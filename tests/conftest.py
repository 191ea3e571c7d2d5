import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pushlake.session import checkpoint_root, local_session

    s = local_session(4, shuffle_partitions=8, app="pushlake-tests")
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets a checkpoint dir only where the session has none
    yield s
    s.stop()
