import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from merchantry.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a frame, or of some of its columns."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect
