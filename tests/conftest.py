import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickwin.session import get_spark
    s = get_spark("local[4]", 8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    # a fresh folder per test; never reused or cleared
    return tempfile.mkdtemp(prefix="clickwin-test-")
