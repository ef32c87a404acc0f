import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stockroom.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="stockroom-tests", shuffle_partitions=4)
    # Use the shared folder the environment names; only a test run without one gets its own.
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stockroom-test-ckpt-"))
    yield s
    s.stop()
