import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("vigil-tests", cpus="*", shuffle_partitions=8)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigil-test-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vigil-test-")
