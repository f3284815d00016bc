import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerostream.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]", 4,
        extra={
            "spark.python.unix.domain.socket.enabled": "true",
            "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
        },
    )
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aerostream-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="aerostream-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
