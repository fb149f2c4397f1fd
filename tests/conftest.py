import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from starmart.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="starmart-test-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
