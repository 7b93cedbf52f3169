"""Column helpers on hand-made rows (FIXTURES §2 cases)."""

from pyspark.sql import functions as F

from rollbook.functions import text as T


def one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_pad_grade_and_sequence(spark):
    rows = [("5",), ("10",), ("PK",), (" 07 ",), (None,), ("K",), ("-1",)]
    assert one(spark, T.pad_grade("g"), rows, "g string") == ["05", "10", "PK", "07", None, "K", "-1"]
    assert one(spark, T.grade_sequence("g"), rows, "g string") == [10, 15, 4, 12, None, 5, 4]


def test_clip_blank_is_null(spark):
    rows = [("  abc  ",), ("   ",), (None,), ("abcdefgh",), ("\tx",)]
    assert one(spark, T.clip("s", 3), rows, "s string") == ["abc", None, None, "abc", "\tx"]


def test_household_key_keeps_separators(spark):
    rows = [("1 main", None, "58000"), (None, None, None)]
    got = one(spark, T.household_key("a", "b", "c"), rows, "a string, b string, c string")
    assert got == ["1 MAIN||58000", "||"]


def test_hhmm(spark):
    assert one(spark, T.hhmm("s"), [(29100,), (0,), (86340,)], "s int") == ["08:05", "00:00", "23:59"]


def test_lunch_code_and_phone(spark):
    rows = [("1",), ("free",), ("R",), ("2",), ("x",), (None,)]
    assert one(spark, T.lunch_status_code("c"), rows, "c string") == ["F", "F", "R", "R", None, None]
    assert one(spark, T.default_phone("c"), [("  ",), ("701",)], "c string") == ["999-999-9999", "701"]


def test_contains_any_substring_semantics(spark):
    rows = [("Vision/eye",), ("agriculture",), ("none",)]
    assert one(spark, T.contains_any("c", ["EYE", "AG"]), rows, "c string") == [True, True, False]


def test_termid_range_equals_floor(spark):
    rows = [(t,) for t in (-250, -200, -101, -100, 0, 99, 100, 599, 600, 1299)]
    df = spark.createDataFrame(rows, "t int")
    a = [r[0] for r in df.select(T.termid_in_years("t", -2, 5)).collect()]
    b = [r[0] for r in df.select(T.yearid_of_termid("t").between(-2, 5)).collect()]
    assert a == b


def test_one_line(spark):
    assert one(spark, T.one_line("c"), [("a\r\nb",)], "c string") == ["a  b"]


def test_cat_skips_nulls(spark):
    assert one(spark, T.cat(F.col("a"), "-", F.col("b")), [("x", None), (None, None)], "a string, b string") == ["x-", "-"]
