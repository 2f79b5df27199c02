import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from baflow.session import get_session
    s = get_session("local[*]", 8)
    if not s.conf.get("spark.checkpoint.dir", None):        # tests only: a fresh local folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="baflow-test-ckpt-"))
    yield s
