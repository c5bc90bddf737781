"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pitlake.session import local_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf():
    return f"{TESTDATA}/sf0.001"
