"""Every registered query against its SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from millrace.session import TABLES
from tests.conftest import SF
from tools.check_oracle import norm

QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_every_check_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert found
        return
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.columns, found) == bag(names, result.fetchall())


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1
