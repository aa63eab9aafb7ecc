from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from martloom.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "martloom-tests")
    yield session
    session.stop()


@pytest.fixture
def as_of():
    return datetime(2030, 1, 1, 12, 0, 0)
