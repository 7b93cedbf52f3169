"""Program extracts and the shared "student scope" stage.

Scope plan (C07): the active yearid is a one-row aggregate over ``cc`` used as a
scalar subquery; ``cc`` is filtered on the raw ``termid`` range, reduced to the
distinct keys the extract keeps (map-side partial aggregation), and only then
joined to ``students``.  A student with a huge enrolment history shrinks to its
distinct keys before any shuffle; AQE's skew join splits what is left.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, contains_any, lunch_status_code, termid_in_years
from rollbook.functions.codes import HOMELESS_SERVICE_FLAGS
from rollbook.operators.quality import empty_fallback, finalize, marker_row, required, resolved
from rollbook.operators.relational import any_flag, dimension, net_balance
from rollbook.operators.years import requested_or_latest_year
from rollbook.params import YEARID_BASE, ExtractParams
from rollbook.plans.common import section_keys, section_keys_in_year, section_year
from rollbook.plans.registry import extract, of_school
from rollbook.sources.catalog import Tables

US_DATE = "MM/dd/yyyy"


# ---- shared stages -------------------------------------------------------------

def active_yearid(t: Tables, p: ExtractParams) -> Column:
    """C04c over cc, as a scalar subquery Column."""
    return requested_or_latest_year(t.cc, p.requested_yearid).scalar()


def scoped_cc(t: Tables, p: ExtractParams, back: int) -> DataFrame:
    """cc rows whose school year lies in [active - back, active]."""
    y = active_yearid(t, p)
    return t.cc.where(col("termid").isNotNull() & termid_in_years("termid", y - back, y))


def scoped_cc_keys(t: Tables, p: ExtractParams, back: int, cc_cols: Sequence[str] = ()) -> DataFrame:
    """Distinct (studentid, cc_cols...) of the scoped enrolments; shared by all
    extracts of a run that ask for the same window and columns."""
    key = ("scoped_cc_keys", p.requested_yearid, back, tuple(cc_cols))
    return t.shared(key, lambda: scoped_cc(t, p, back).select("studentid", *cc_cols).distinct())


def student_scope(t: Tables, p: ExtractParams, back: int, cc_cols: Sequence[str] = (),
                  student_cols: Sequence[str] = ()) -> DataFrame:
    """DISTINCT (studentid, studentNum, cc_cols..., student_cols...) of
    students with a course enrolment in the last ``back + 1`` school years."""
    c = scoped_cc_keys(t, p, back, cc_cols)
    s = t.students.where(col("student_number").isNotNull()).select(
        col("id").alias("_sid"), col("student_number").alias("studentNum"), *student_cols)
    return c.join(s, c["studentid"] == s["_sid"]).drop("_sid")


def student_keys_in_scope(t: Tables, p: ExtractParams, back: int, key: str = "id") -> DataFrame:
    """Distinct (key, studentNum) of in-scope students (semi-join form of C07)."""
    c = scoped_cc_keys(t, p, back).select(col("studentid").alias("_sid"))
    s = t.students.where(col("student_number").isNotNull()).select(
        col("id").alias("_id"), col(key).alias("_key"), col("student_number").alias("studentNum"))
    return s.join(c, s["_id"] == c["_sid"], "left_semi").select("_key", "studentNum")


def students_in_section_year(t: Tables, extra: Sequence[str] = ()) -> DataFrame:
    """Distinct students enrolled (cc ⋈ sections ⋈ terms) in the newest section year."""
    secs = section_keys_in_year(t, section_year(t)).select(col("id").alias("_secid"))
    c = t.cc.select(col("studentid"), col("sectionid")).join(
        secs, col("sectionid") == col("_secid"), "left_semi").select("studentid").distinct()
    s = t.students.where(col("student_number").isNotNull()).select(
        col("id").alias("_sid"), col("student_number").cast("string").alias("studentNum"), *extra)
    return s.join(c, s["_sid"] == c["studentid"], "left_semi")


def student_program(df: DataFrame, fallback_code: str, columns=("studentNum", "startDate"),
                    rules=None):
    """Shared tail: clip studentNum, validate, type, one ERROR row when empty."""
    x = df.withColumn("studentNum", clip(col("studentNum"), 15))
    if rules is None:
        rules = [required("studentNum", blank=True), required("startDate")]
    out = finalize(x, list(columns), rules)
    return empty_fallback(out, {"row_type": "ERROR", "validation_errors": fallback_code})


# ---- E51 CTE -----------------------------------------------------------------

# course-name keywords that mark career/technical courses (fixed values)
CTE_KEYWORDS = ("CTE", "CAREER", "TECH", "AG", "WELD", "AUTO", "MED")


@extract("CTE", batch=4, date_format=US_DATE)
def cte(t: Tables, p: ExtractParams) -> DataFrame:
    sc = student_scope(t, p, 6, cc_cols=("dateenrolled", "course_number"))
    courses = t.courses.select(col("course_number").alias("_cn"), "vocational", "course_name")
    j = sc.join(courses, sc["course_number"] == courses["_cn"]).where(
        (col("vocational") == 1) | contains_any("course_name", CTE_KEYWORDS))
    src = j.select(col("studentNum").cast("string").alias("studentNum"),
                   F.coalesce(col("dateenrolled"), F.lit(p.as_of_date).cast("date")).alias("startDate")).distinct()
    return student_program(src, "ERR_NO_CTE_SOURCE_ROWS_FOUND; ")


# ---- E49 freeReducedEligibility ------------------------------------------------

@extract("freeReducedEligibility", batch=4, date_format=US_DATE)
def free_reduced(t: Tables, p: ExtractParams) -> DataFrame:
    y = active_yearid(t, p)
    sc = student_scope(t, p, 1, cc_cols=("dateenrolled",),
                       student_cols=(F.trim(col("lunchstatus")).alias("lunchstatus"),))
    src = sc.where(F.upper(col("lunchstatus")).isin("1", "2", "F", "R", "FREE", "REDUCED")).select(
        col("studentNum").cast("string").alias("studentNum"),
        lunch_status_code(col("lunchstatus")).alias("eligibility"),
        col("dateenrolled").alias("startDate"),
        F.lit(None).cast("date").alias("endDate"),
        (F.lit(YEARID_BASE) + y).cast("int").alias("endYear"),
    )
    rules = [required("studentNum", blank=True), required("eligibility"), required("startDate"),
             required("endYear")]
    return student_program(src, "ERR_NO_SOURCE_ROWS_FOR_FREEREDUCEDELIGIBILITY; ",
                           ("studentNum", "eligibility", "startDate", "endDate", "endYear"), rules)


# ---- E50 districtResidency (C24) ----------------------------------------------

@extract("districtResidency", batch=4, date_format=US_DATE)
def district_residency(t: Tables, p: ExtractParams) -> DataFrame:
    """First enrolment date per student in the 7-year window: min is computed
    per studentid on cc first (partial aggregation), then mapped to the number."""
    c = scoped_cc(t, p, 6).groupBy("studentid").agg(F.min("dateenrolled").alias("_d"))
    s = t.students.where(col("student_number").isNotNull()).select(
        col("id").alias("_sid"), col("student_number").alias("sn"))
    j = c.join(s, c["studentid"] == s["_sid"])
    src = j.groupBy("sn").agg(F.min("_d").alias("startDate")).select(
        col("sn").cast("string").alias("studentNum"), "startDate")
    return student_program(src, "ERR_NO_DISTRICT_RESIDENCY_ROWS_FOUND; ")


# ---- E52 earlyLearning --------------------------------------------------------

# grade levels counted as early learning (fixed values)
EARLY_GRADES = (-2, -1, 0)


@extract("earlyLearning", batch=4, date_format=US_DATE)
def early_learning(t: Tables, p: ExtractParams) -> DataFrame:
    sc = student_scope(t, p, 6, cc_cols=("dateenrolled",), student_cols=("grade_level",))
    src = sc.where(col("grade_level").isin(*EARLY_GRADES)).select(
        col("studentNum").cast("string").alias("studentNum"),
        F.coalesce(col("dateenrolled"), F.lit(p.as_of_date).cast("date")).alias("startDate"))
    return student_program(src, "ERR_NO_EARLYLEARNING_ROWS_FOUND; ")


# ---- E53 / E54 homeless, homelessService -----------------------------------------

def _homeless_rows(t: Tables, p: ExtractParams) -> DataFrame:
    sc = student_keys_in_scope(t, p, 6, key="dcid")
    h = t.s_nd_stu_homelessprograms_c.where(col("startdate").isNotNull())
    return h.join(sc, h["studentsdcid"] == sc["_key"])


@extract("homeless", batch=4, date_format=US_DATE, key=("studentNum", "startDate"))
def homeless(t: Tables, p: ExtractParams) -> DataFrame:
    src = _homeless_rows(t, p).select(col("studentNum").cast("string").alias("studentNum"),
                                      col("startdate").alias("startDate"))
    return student_program(src, "ERR_NO_SOURCE_ROWS_FOR_HOMELESS; ")


@extract("homelessService", batch=4, date_format=US_DATE)
def homeless_service(t: Tables, p: ExtractParams) -> DataFrame:
    rows = _homeless_rows(t, p).where(any_flag(HOMELESS_SERVICE_FLAGS) == 1)
    src = rows.select(col("studentNum").cast("string").alias("studentNum"), col("startdate").alias("startDate"))
    return student_program(src, "ERR_NO_SOURCE_ROWS_FOR_HOMELESSSERVICE; ")


# ---- E55 section504 ------------------------------------------------------------

@extract("section504", batch=4, date_format=US_DATE)
def section504(t: Tables, p: ExtractParams) -> DataFrame:
    sc = student_keys_in_scope(t, p, 6, key="dcid")
    x = t.s_nd_stu_x.where(col("section504") == 1)
    j = x.join(sc, x["studentsdcid"] == sc["_key"])
    src = j.select(F.substring(col("studentNum").cast("string"), 1, 15).alias("studentNum"),
                   F.to_date(col("whencreated")).alias("startDate"))
    return student_program(src, "ERR_NO_SOURCE_ROWS_FOR_SECTION504; ")


# ---- E31 attendanceAggregate ------------------------------------------------------

@extract("attendanceAggregate", batch=3, date_format=US_DATE, key=("studentNum", "date"))
def attendance_aggregate(t: Tables, p: ExtractParams) -> DataFrame:
    """One row per attendance record of an in-scope student (not aggregated)."""
    sc = student_keys_in_scope(t, p, 6, key="id")
    a = t.attendance.where(col("att_date").isNotNull())
    j = a.join(sc, a["studentid"] == sc["_key"])
    src = j.select(F.substring(col("studentNum").cast("string"), 1, 15).alias("studentNum"),
                   col("att_date").alias("date"))
    x = src.withColumn("studentNum", clip(col("studentNum"), 15))
    out = finalize(x, ["studentNum", "date"], [required("studentNum", blank=True),
                                               ("ERR_REQUIRED_date", col("date").isNull())])
    return empty_fallback(out, {"row_type": "ERROR",
                                "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_ATTENDANCEAGGREGATE; "})


# ---- E56 fee / E57 courseFee ---------------------------------------------------------

@extract("fee", batch=4)
def fee(t: Tables, p: ExtractParams) -> DataFrame:
    """Net amount per (student, fee name, fee type), zero balances dropped."""
    sc = students_in_section_year(t)
    # scope first, then one sum; groups are the whole name and type, cut only on the way out
    ft = t.fee_transaction.select("feeid", "studentid", "neteffect").join(sc, col("studentid") == sc["_sid"])
    f = t.fee.select(col("id").alias("_fid"), "fee_type_name", "fee_type_id")
    j = ft.join(f, ft["feeid"] == f["_fid"])
    g = net_balance(j, ["studentNum", "fee_type_name", "fee_type_id"], "neteffect", alias="amount") \
        .select("studentNum", F.substring("fee_type_name", 1, 60).alias("feeName"),
                F.substring("fee_type_id", 1, 10).alias("feeType"), "amount")
    rules = [required("feeName", blank=True), required("feeType", blank=True), required("amount")]
    out = finalize(g, ["studentNum", "feeName", "feeType", "amount"], rules)
    return empty_fallback(out, {"row_type": "ERROR", "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_FEE; "})


@extract("courseFee", batch=4, school="schoolNum")
def course_fee(t: Tables, p: ExtractParams):
    """Fees of the newest section year on courses, for each school with a section in that year and
    each term in which a section of the course runs there."""
    y = section_year(t)
    scope = section_keys_in_year(t, y).select(col("schoolid").alias("_schid")).distinct()
    schools = t.schools.select(col("id").alias("_schid"), "school_number").join(scope, "_schid", "left_semi")
    # the sections shrink to their (school, course, term) keys of these schools before they meet the fees
    keys = (of_school(t, p, section_keys(t), "schoolid").join(dimension(schools), col("schoolid") == col("_schid"))
            .select("school_number", col("course_number").alias("_scn"), "termid").distinct())
    names = t.terms.select(col("id").alias("_tid"), "abbreviation").distinct()
    f = t.fee.where(col("course_number").isNotNull() & (col("yearid") == y)).select("course_number", "fee_type_name").distinct()
    src = (f.join(keys, col("course_number") == col("_scn")).join(dimension(names), col("termid") == col("_tid"))
           .select(F.substring("fee_type_name", 1, 30).alias("feeName"),
                   F.substring(col("school_number").cast("string"), 1, 7).alias("schoolNum"),
                   F.substring("abbreviation", 1, 30).alias("calendarName"),
                   F.substring("course_number", 1, 13).alias("courseNum")).distinct())
    rules = [required(c, blank=True) for c in ("feeName", "schoolNum", "calendarName", "courseNum")]
    out = finalize(src, ["feeName", "schoolNum", "calendarName", "courseNum"], rules)
    return empty_fallback(out, {"row_type": "ERROR", "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_COURSEFEE; "})


# ---- E58–E73 programs with no source -----------------------------------------------
#
# The source system has no table for these programs yet: each script fixes the
# target columns, the required fields and the marker row, and leaves the
# source empty.  ``placeholder_program`` builds the same typed-empty extract;
# a real source can be passed as ``source`` (a function of tables, params).

PLACEHOLDER_SPECS = {
    # name: (columns with types, required, marker values)
    "gifted": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
               {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_GIFTED; "}),
    "Iep": ([("studentNum", "string"), ("programStatus", "string")], ["studentNum", "programStatus"],
            {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_IEP; "}),
    "IepServiceND": ([("studentNum", "string"), ("startDate", "date"), ("serviceType", "string")],
                     ["studentNum", "startDate", "serviceType"],
                     {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_IEPSERVICE; "}),
    "fosterCare": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                   {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_FOSTERCARE; "}),
    "homeSchool": ([("studentNum", "string"), ("startDate", "date"), ("endDate", "date"), ("date", "date"),
                    ("visitDate", "date"), ("visitTime", "string"), ("flagName", "string"),
                    ("programStatus", "string"), ("serviceType", "string"), ("eligibility", "string"),
                    ("endYear", "int"), ("feeName", "string"), ("feeType", "string"),
                    ("amount", "decimal(6,2)"), ("schoolNum", "string"), ("calendarName", "string"),
                    ("courseNum", "string"), ("lockerNum", "string"), ("lockerType", "string"),
                    ("employNum", "string")], ["studentNum", "startDate"],
                   {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_HOMESCHOOL; "}),
    "migrant": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_MIGRANT; "}),
    "militaryConnections": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                            {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_MILITARYCONNECTIONS; "}),
    "pregnantAndParenting": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                             {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_PREGNANTANDPARENTING; "}),
    "SAAP": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
             {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_SAAP_ALTERNATIVEEDUCATION; "}),
    "twentyFirstCCLC": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                        {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_TWENTYFIRSTCCLC; "}),
    "title1PartA": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                    {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_TITLE1PARTA; "}),
    "title1PartD": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
                    {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_TITLE1PARTD; "}),
    "title3": ([("studentNum", "string"), ("startDate", "date")], ["studentNum", "startDate"],
               {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_TITLE3; "}),
    "flag": ([("flagName", "string")], ["flagName"],
             {"flagName": "MISSING_SOURCE_FLAGS",
              "validation_errors": "ERR_NO_FLAG_SOURCE_CONFIGURED_OR_NO_FLAG_ROWS; "}),
    "flagParticipation": ([("studentNum", "string"), ("flagName", "string"), ("startDate", "date")],
                          ["studentNum", "flagName", "startDate"],
                          {"flagName": "MISSING_SOURCE_FLAGPARTICIPATION",
                           "validation_errors": "ERR_NO_FLAGPARTICIPATION_SOURCE_CONFIGURED_OR_NO_FLAG_ROWS; "}),
    "locker": ([("schoolNum", "string"), ("lockerNum", "string"), ("lockerType", "string"),
                ("studentNum", "string")], [],
               {"validation_errors": "ERR_NO_SOURCE_ROWS_FOR_LOCKER; "}),
}


def placeholder_program(t: Tables, name: str, source=None, params: ExtractParams | None = None) -> DataFrame:
    return resolved(placeholder_rows(t, name, source, params))


def placeholder_rows(t: Tables, name: str, source=None, params: ExtractParams | None = None):
    cols, req, marker = PLACEHOLDER_SPECS[name]
    spark = t.spark
    if source is None:
        schema = ", ".join(f"`{c}` {ty}" for c, ty in cols)
        src = spark.createDataFrame([], schema)
    else:
        src = source(t, params or ExtractParams())
    rules = [required(c, blank=(dict(cols)[c] == "string")) for c in req]
    if name == "locker":  # every locker row is an error until a source exists
        rules = [("ERR_NO_SOURCE_ROWS_FOR_LOCKER", F.lit(True))]
    out = finalize(src, [c for c, _ in cols], rules)
    if name == "locker":
        # the locker file always carries its marker row
        return out.unionByName(marker_row(out, {"row_type": "ERROR", **marker}))
    return empty_fallback(out, {"row_type": "ERROR", **marker})


def _register_placeholders():
    batches = {"flag": 4, "flagParticipation": 4, "locker": 4}
    for name in PLACEHOLDER_SPECS:
        def fn(t, p, _n=name):
            return placeholder_rows(t, _n, params=p)
        extract(name, batch=batches.get(name, 4), date_format=US_DATE, reads_tables=False)(fn)


_register_placeholders()
