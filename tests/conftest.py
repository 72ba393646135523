import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session
    s = local_session("*", 8)
    yield s
    s.stop()


def values(df, col=None):
    col = col or df.columns[0]
    return [r[col] for r in df.collect()]
