"""One session for all tests."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from voxloom.session import build_session

    session = build_session("tests", 4, 4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a table as sorted tuples."""

    def get(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)

    return get
