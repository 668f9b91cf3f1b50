import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabforge.session import local_session, release_scratch
    s = local_session("*", shuffle_partitions=8)
    yield s
    release_scratch(s)
    s.stop()
