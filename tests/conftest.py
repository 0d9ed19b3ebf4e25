import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from trustframe.session import ensure_checkpoint_dir, get_spark
    s = get_spark("local[4]", 8, "trustframe-tests")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
