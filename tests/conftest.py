import os
import sys
from pathlib import Path

import pytest

# Python workers import the functions defined in the tests from here.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(Path(__file__).parent), os.environ.get("PYTHONPATH", "")]
)
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfwise.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "4")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"
