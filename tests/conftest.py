import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from orrery.session import get_session
    s = get_session("local[*]", app="orrery-tests", shuffle_partitions=8)
    # tests only: a scratch checkpoint folder when the session names none
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orrery-test-ckpt-"))
    yield s
    s.stop()
