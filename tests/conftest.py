import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from histdim.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="histdim-tests",
                      extra={"spark.driver.memory": "4g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="histdim-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="histdim-test-")
