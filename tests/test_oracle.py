"""Every registered query against its DuckDB oracle on the smallest scale
factor: same columns, same row count, same multiset of values."""

import datetime as dt
import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from rollbook.sources.views import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
CORPUS = {k for m in E._corpus() for k in m.QUERIES}
KEYS = sorted(set(E.oracle_sql()) - CORPUS)


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_query_has_oracle():
    missing = set(E.queries()) - CORPUS - set(E.oracle_sql())
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "row_type" and df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, rel.columns)
