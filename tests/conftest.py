import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from caudal.session import local_session

    return local_session(8, partitions=4)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
