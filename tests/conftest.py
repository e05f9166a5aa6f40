import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {
    "0.001": "/root/testdata/sf0.001",
    "0.01": "/root/testdata/sf0.01",
}


@pytest.fixture(scope="session")
def spark():
    from stategrid.session import get_session
    s = get_session("local[*]", app="stategrid-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
