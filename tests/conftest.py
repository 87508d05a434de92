import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanlake.session import get_spark, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark(master="local[4]", shuffle_partitions=8, app="urbanlake-tests")
    yield s


@pytest.fixture
def scratch(spark):
    """A fresh folder under the session's checkpoint dir (never reused)."""
    return lambda name="t": shared_dir(spark, name)


def rows(df, *cols):
    """Collect ``cols`` (default all) as a list of tuples."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
