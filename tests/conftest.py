import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hourcast.session import build_session

    s = build_session("local[4]", "hourcast-tests", shuffle_partitions=4)
    # Tests own their checkpoint folder only where the session has none.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hourcast-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
