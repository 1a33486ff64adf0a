import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from nightledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def rows():
    """A result as a sorted list of tuples."""

    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is not None, str(type(x)), x) for x in t))

    return of
