"""Every query with SQL against DuckDB on the smallest tables."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest

from caudal.queries import load

duckdb = pytest.importorskip("duckdb")
DATA = Path("/root/testdata/sf0.001")
QUERIES, SQL = load()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    return v.isoformat() if isinstance(v, date) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    cur = db.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, str(DATA)).columns
