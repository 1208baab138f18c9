import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationlab.session import checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="stationlab-tests", shuffle_partitions=4)
    # tests own their session, so they may set the checkpoint folder
    checkpoint_dir(s, tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="out-", dir="/tmp")
