import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from starling.session import build_session
    scratch = tempfile.mkdtemp(prefix="starling-test-")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="starling-t-")
