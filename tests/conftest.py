import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlint.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="ledgerlint-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


def rows(df, order=None):
    """Collect as plain tuples, sorted for comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
