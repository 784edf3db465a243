import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lienlake.session import build_session
    s = build_session("local[8]", shuffle_partitions=8, app_name="lienlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh directory under the session's lake root."""
    from lienlake.session import scratch_path
    return scratch_path(spark, "test")


@pytest.fixture()
def local_dir():
    return tempfile.mkdtemp(prefix="lienlake-test-")
