import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIX = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkfolio.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, extra={
        # tests set their own checkpoint folder; a cluster names a shared one
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="sparkfolio-test-ckpt-"),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    yield s
    s.stop()


@pytest.fixture
def fix():
    return lambda name: os.path.join(FIX, name)
