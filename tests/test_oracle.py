"""Every core query against its SQL, on the smallest tables."""

import datetime
import os

import duckdb
import pytest

from qafila import catalog

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(round(float(v), 6))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"create view {f[:-8]} as select * from '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
