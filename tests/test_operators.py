"""Operators on hand-made frames."""

import datetime as d

from pyspark.sql import functions as F

from rollbook.operators import quality as Q
from rollbook.operators import relational as R
from rollbook.plans.people import login_window_open


def test_validate_and_row_type(spark):
    df = spark.createDataFrame([("a", None), (None, d.date(2020, 1, 1)), ("b", d.date(2020, 1, 1))], "s string, dt date")
    out = Q.finalize(df, ["s", "dt"], [Q.required("s"), Q.required("dt")]).collect()
    assert [(r.row_type, r.validation_errors) for r in out] == [
        ("ERROR", "ERR_REQUIRED_dt;"), ("ERROR", "ERR_REQUIRED_s;"), ("CLEAN", None)]


def test_row_type_severity(spark):
    df = spark.createDataFrame([("WARN_X;",), ("ERR_Y; WARN_X;",), (None,)], "e string")
    got = [r[0] for r in df.select(Q.row_type_severity("e")).collect()]
    assert got == ["CLEAN", "ERROR", "CLEAN"]


def test_empty_fallback(spark):
    empty = spark.createDataFrame([], "row_type string, s string, validation_errors string")
    out = Q.empty_fallback(empty, {"row_type": "ERROR", "validation_errors": "ERR_NONE; "}).resolved().collect()
    assert [tuple(r) for r in out] == [("ERROR", None, "ERR_NONE; ")]
    full = spark.createDataFrame([("CLEAN", "x", None)], "row_type string, s string, validation_errors string")
    assert Q.empty_fallback(full, {"row_type": "ERROR"}).resolved().count() == 1


def test_dedup_first_prefers_history_then_open_end(spark):
    rows = [("1", d.date(2020, 1, 1), "STUDENTS", None), ("1", d.date(2020, 1, 1), "REENROLLMENTS", d.date(2020, 5, 1)),
            ("2", d.date(2020, 1, 1), "STUDENTS", d.date(2020, 2, 1)), ("2", d.date(2020, 1, 1), "STUDENTS", None)]
    df = spark.createDataFrame(rows, "k string, s date, src string, e date")
    out = R.dedup_first(df, ["k", "s"], [F.when(F.col("src") == "REENROLLMENTS", 0).otherwise(1),
                                         F.col("e").asc_nulls_last()])
    got = sorted((r.k, r.src, r.e) for r in out.collect())
    assert got == [("1", "REENROLLMENTS", d.date(2020, 5, 1)), ("2", "STUDENTS", d.date(2020, 2, 1))]


def test_overlap_join_open_ended(spark):
    enr = spark.createDataFrame([("s1", d.date(2019, 3, 1), None), ("s2", d.date(2018, 9, 1), d.date(2018, 12, 1))],
                                "k string, a date, b date")
    cal = spark.createDataFrame([("s1", d.date(2018, 8, 20), d.date(2019, 5, 31)),
                                 ("s1", d.date(2019, 8, 20), d.date(2020, 5, 31)),
                                 ("s2", d.date(2018, 8, 20), d.date(2019, 5, 31)),
                                 ("s2", d.date(2019, 8, 20), d.date(2020, 5, 31))], "ck string, f date, l date")
    out = R.overlap_join(enr, cal, [("k", "ck")], "a", "b", "f", "l").collect()
    assert sorted((r.k, r.f.year) for r in out) == [("s1", 2018), ("s1", 2019), ("s2", 2018)]


def test_listagg_priority_nulls_last(spark):
    rows = [(1, "b@x", 2), (1, "a@x", 1), (1, "c@x", None), (2, None, 1)]
    df = spark.createDataFrame(rows, "p int, e string, pr int")
    out = R.listagg_ordered(df, ["p"], F.col("e"), [F.col("pr").isNull().cast("int"), F.col("pr"), F.col("e")],
                            alias="l").collect()
    assert {r.p: r.l for r in out} == {1: "a@x; b@x; c@x", 2: None}


def test_pivot_current_address_only(spark):
    rows = [(1, 19, "old st", d.date(2000, 1, 1)), (1, 19, "new st", None), (1, 20, "po box", None)]
    df = spark.createDataFrame(rows, "p int, t int, street string, ended date").where("ended is null")
    out = R.pivot_conditional_max(df, ["p"], {"phys": (F.col("t") == 19, F.col("street")),
                                             "mail": (F.col("t") == 20, F.col("street"))}).collect()
    assert (out[0].phys, out[0].mail) == ("new st", "po box")


def test_net_balance_drops_zero(spark):
    df = spark.createDataFrame([("s", 10.0), ("s", -10.0), ("t", 5.0), ("t", 0.0)], "k string, v double")
    out = R.net_balance(df.withColumn("v", F.col("v").cast("decimal(12,2)")), ["k"], "v").collect()
    assert [(r.k, str(r.amount)) for r in out] == [("t", "5.00")]


def test_login_window(spark):
    # as-of 1998-10-15 is day serial 36083
    rows = [(0, None), (-1, None), (None, None), (36500, None), (35000, 36000), (35000, 36100)]
    df = spark.createDataFrame(rows, "s int, e int")
    got = [r[0] for r in df.select(login_window_open("s", "e", d.date(1998, 10, 15))).collect()]
    assert got == [True, True, True, False, False, True]


def test_school_key_map_dedupes_coinciding_ids(spark):
    sch = spark.createDataFrame([(7, 7, 7, "Same")], "id int, dcid int, school_number int, name string")
    assert R.school_key_map(sch).count() == 1
    assert R.school_key_map(sch, dedupe=False).count() == 3
    two = spark.createDataFrame([(1, 1, 100, "A"), (2, 2, 100, "B")], "id int, dcid int, school_number int, name string")
    assert {r.schoolName for r in R.school_key_map(two).where("school_key = 100").collect()} == {"A", "B"}


def test_check_unique_and_reference(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,)], "k int")
    assert [tuple(r) for r in Q.check_unique(a, ["k"]).collect()] == [(1, 2)]
    assert [r.k for r in Q.check_reference(a, b, ["k"]).collect()] == [1]


def test_quality_summary(spark):
    df = spark.createDataFrame([("ERROR", "ERR_A; ERR_B;"), ("ERROR", "ERR_A;"), ("CLEAN", None)],
                               "row_type string, validation_errors string")
    got = {(r.kind, r.item): r.n for r in Q.quality_summary(df, "x").collect()}
    assert got == {("row_type", "ERROR"): 2, ("row_type", "CLEAN"): 1, ("error_code", "ERR_A"): 2,
                   ("error_code", "ERR_B"): 1}


def test_listagg_bounded_prefix_is_exact(spark):
    """A person with very many values: the bounded fold gives the same clipped text."""
    from rollbook.functions.text import clip
    rows = [(1, f"v{i:04d}", i % 7) for i in range(3000)] + [(2, "  ", 1), (2, "x", 2)]
    df = spark.createDataFrame(rows, "p int, v string, o int")
    order = [F.col("o"), F.col("v")]
    full = R.listagg_ordered(df, ["p"], F.col("v"), order, alias="l").select("p", clip("l", 40).alias("c"))
    capped = R.listagg_ordered(df, ["p"], F.col("v"), order, alias="l", max_chars=40) \
        .select("p", clip("l", 40).alias("c"))
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, capped.collect()))
