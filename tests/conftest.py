import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from evallens.session import local_session

    s = local_session("*", shuffle_partitions=8, app="evallens-tests")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
