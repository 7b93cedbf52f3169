"""Property tests: Spark column rules against plain-Python models on generated rows."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollbook.functions import text as T
from rollbook.operators import quality as Q

TEXT = st.one_of(st.none(), st.text(alphabet=" ab1\t", max_size=4))
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def py_blank(v):
    return v is None or v.strip(" ") == ""


def py_errors(a, b, c):
    codes = []
    if a is None:
        codes.append("ERR_REQUIRED_a; ")
    if py_blank(b):
        codes.append("ERR_REQUIRED_b; ")
    if c is not None and c.strip(" ") == "1":
        codes.append("ERR_INVALID_c; ")
    s = "".join(codes).strip(" ")
    return s or None


@SETTINGS
@given(st.lists(st.tuples(TEXT, TEXT, TEXT), min_size=1, max_size=40))
def test_validate_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = Q.finalize(df, ["a", "b", "c"], [Q.required("a"), Q.required("b", blank=True),
                                          Q.rule("ERR_INVALID_c", F.trim("c") == "1")])
    got = sorted(repr((r.a, r.b, r.c, r.row_type, r.validation_errors)) for r in out.collect())
    want = sorted(repr((a, b, c, "CLEAN" if py_errors(a, b, c) is None else "ERROR", py_errors(a, b, c)))
                  for a, b, c in rows)
    assert got == want


def py_pad(v):
    if v is None:
        return None
    t = v.strip(" ")
    if len(t) == 1 and t.isdigit():
        return "0" + t
    return t or None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" 0129KP-", max_size=3)), min_size=1, max_size=40))
def test_pad_grade_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "g string")
    got = [r[0] for r in df.select(T.pad_grade("g")).collect()]
    assert got == [py_pad(v) for v in values]


def py_clip(v, n):
    if v is None:
        return None
    t = v.strip(" ")[:n]
    return t or None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" xyz\t", max_size=8)), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=5))
def test_clip_matches_model(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(T.clip("s", n)).collect()]
    assert got == [py_clip(v, n) for v in values]
