import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from adresponse.session import local_session

    scratch = tempfile.mkdtemp(prefix="adresponse-test-")
    s = local_session("*", shuffle_partitions=8, app="adresponse-tests", warehouse=os.path.join(scratch, "wh"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="adresponse-run-")
