import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from usagelens.session import checkpoint_dir, get_spark
    s = get_spark("local[4]", app="usagelens-tests", shuffle_partitions=4)
    # tests run without a cluster: name a scratch checkpoint folder only
    # because the session has none
    checkpoint_dir(s, tempfile.mkdtemp(prefix="usagelens-ck-", dir="/tmp"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="usagelens-t-", dir="/tmp")
