import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparktab.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, app="sparktab-tests")
    yield s


@pytest.fixture(scope="session")
def smoke_dir():
    return SMOKE_DIR
