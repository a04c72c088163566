import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import Tables, build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def t(spark):
    return Tables(spark, SF)


def rows(df, *cols):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
