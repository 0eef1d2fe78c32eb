import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pairforge.session import get_session

    s = get_session("local[4]", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    import tempfile

    return tempfile.mkdtemp(prefix="pairforge-test-", dir=os.environ.get("TMPDIR", "/tmp"))
