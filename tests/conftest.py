import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    ckpt = tempfile.mkdtemp(prefix="ledgerline-test-ckpt-")
    s = build_session("local[4]", app="ledgerline-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")


SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
