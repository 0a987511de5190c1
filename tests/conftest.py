import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from insight.session import build_session
    s = build_session(master="local[4]", app="insight-tests", shuffle_partitions=4,
                      conf={"spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="insight-test-ckpt-"))
    yield s
    s.stop()
