import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallyhouse.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, memory="4g")


@pytest.fixture(scope="session")
def small():
    return SMALL
