from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from goldpan.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session("goldpan-tests", "8", partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return str(DATA / "sf0.01")
