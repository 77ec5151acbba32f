import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skytally.session import build_session, checkpoint_root

    s = build_session("local[*]", app="skytally-tests", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "line string")
    return make


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (or all columns)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
