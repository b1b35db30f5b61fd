import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revloom.session import local  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
