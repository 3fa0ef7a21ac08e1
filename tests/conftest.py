import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, app="tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a table as a sorted list of tuples."""

    def collect(df, *columns):
        found = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in found), key=repr)

    return collect
