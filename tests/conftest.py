import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from marketscope.session import get_session
    s = get_session("local[8]", shuffle_partitions=8)
    if not (s.sparkContext.getConf().get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ms-test-ckpt-"))
    yield s


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)
