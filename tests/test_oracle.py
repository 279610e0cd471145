"""Every query with a twin gives the same rows as DuckDB."""

import datetime
import decimal
import os

import duckdb
import pytest

from strataforge import job_queries  # noqa: F401 (registers its queries)
from strataforge.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return f"{float(v):.6g}"
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_duckdb(spark, con, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
