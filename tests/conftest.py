import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from portrisk.session import local_session

    return local_session("4", 4, spark__sql__warehouse__dir="/tmp/portrisk-warehouse")


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

    return collect


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
