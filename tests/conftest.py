import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from quayside.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, nulls first."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
