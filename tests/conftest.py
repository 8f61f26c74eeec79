import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from clickweave.session import checkpoint_root, local_session

    s = local_session(4, shuffle_partitions=4, app="clickweave-tests")
    checkpoint_root(s)
    yield s
    s.stop()
