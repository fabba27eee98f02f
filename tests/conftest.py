import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from basketry.session import build_session
    s = build_session("local[*]", 8, app="basketry-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="basketry-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from basketry.oracle.harness import duck_connect
    return duck_connect(SMALL)
