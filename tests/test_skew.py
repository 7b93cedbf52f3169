"""A hot key holding a third of all rows: results stay exact.

One student receives a third of all course enrolments (and one fee a third of
all transactions); the extracts are compared with their DuckDB oracle texts
run on the same skewed tables."""

import datetime as dt
import decimal
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle import SQL, all_sql
from rollbook.params import ExtractParams
from rollbook.plans.registry import all_extracts
from rollbook.sources import views
from rollbook.sources.views import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral_value() else str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark, tables):
    hot = tables.students.where("student_number is not null").orderBy("id").limit(1).collect()[0].id
    cc = tables.cc.withColumn("studentid", F.when(F.abs(F.hash("sectionid", "dateenrolled")) % 3 == 0,
                                                  F.lit(hot)).otherwise(F.col("studentid")))
    ft = tables.fee_transaction.withColumn("studentid", F.when(F.abs(F.hash("feeid", "neteffect")) % 3 == 0,
                                                               F.lit(hot)).otherwise(F.col("studentid")))
    t = tables.with_tables(cc=cc, fee_transaction=ft)
    con = duckdb.connect()
    for name in DRIVER_TABLES:
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    con.register("cc_df", cc.toPandas())
    con.sql("create view cc as select * from cc_df")
    con.register("ft_df", ft.toPandas())
    con.sql("create view fee_transaction as select * from ft_df")
    all_sql()  # fill the registry
    return t, con


@pytest.mark.parametrize("key", ["districtResidency", "CTE", "attendanceAggregate", "fee", "roster",
                                 "earlyLearning", "freeReducedEligibility"])
def test_hot_student_exact(skewed, key):
    t, con = skewed
    df = all_extracts()[key](t, ExtractParams())
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(views.with_views(SQL[key], provided=("cc", "fee_transaction")))
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(rows, df.columns) == _digest(orows, rel.columns)
