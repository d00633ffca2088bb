"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as registry

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        con.execute(f"create view {table} as select * from read_parquet('{DATA}/{name}')")
    yield con
    con.close()


def cell(value):
    if value is None or value != value:
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = registry.queries()[name](spark, DATA)
    found = canonical(df.columns, df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert found[1]
        return
    wanted = duck.sql(sql)
    assert found == canonical(wanted.columns, wanted.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() == 3
