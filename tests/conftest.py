import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from starweave.session import local_session

    s = local_session(app="starweave-tests", cores="4", shuffle_partitions=4)
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
