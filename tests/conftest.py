import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bizlens.session import local_session

    return local_session(8, shuffle_partitions=8)


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns if none)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(map(str, t)))
