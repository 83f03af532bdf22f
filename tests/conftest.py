import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quayside.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="quayside-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(spark):
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="quayside-test-")


SF_SMALL = "/root/testdata/sf0.001"
