import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pitchcast.session import build_session
    s = build_session(master="local[4]", app="pitchcast-tests", shuffle_partitions=2)
    yield s
    s.stop()


def collect(df, *cols):
    """Rows as dicts (or tuples of the given columns), in collect order."""
    rows = df.collect()
    if cols:
        return [tuple(r[c] for c in cols) for r in rows]
    return [r.asDict() for r in rows]
