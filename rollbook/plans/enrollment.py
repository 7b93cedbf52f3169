"""Enrolment extracts: enrollment (E19, the flagship) and gradeLevel.

Plan shape (enrollment):
  students ∪ reenrollments (tagged)                       -- two scans, no shuffle
  ⋈ key map (broadcast, bounded by #schools)              -- map-side
  ⋈ year-record calendars (broadcast, #schools x #years)  -- equi school + overlap residual
  -> clip/pad projection -> row_number dedup (WindowGroupLimit, one shuffle)
  -> validate -> row_type                                 -- projection
One shuffle in total (the dedup), keyed by the full enrolment key, so a hot
school or student does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, no_show, pad_grade
from rollbook.operators.quality import finalize, required_all
from rollbook.operators.relational import dedup_first, dimension, overlap_join, union_all, union_tagged
from rollbook.params import ExtractParams
from rollbook.plans.common import key_map, yearrec_calendars
from rollbook.plans.registry import extract, of_school
from rollbook.sources.catalog import Tables


def enrolment_sources(t: Tables, p: ExtractParams) -> DataFrame:
    """Current enrolments (students) + history (reenrollments ⋈ students, of whichever school they are in now)."""
    s = t.students
    base = of_school(t, p, s, "schoolid").where(col("entrydate").isNotNull()).select(
        col("id").alias("studentid"),
        col("student_number").cast("string").alias("studentNum_raw"),
        col("entrydate").alias("startDate_raw"),
        col("exitdate").alias("endDate_raw"),
        col("grade_level").alias("grade_level_raw"),
        col("schoolid").cast("long").alias("school_key"),
        F.substring(col("entrycode"), 1, 20).alias("localStartStatus_raw"),
        F.substring(col("exitcode"), 1, 20).alias("localEndStatus_raw"),
    )
    r = of_school(t, p, t.reenrollments, "schoolid").where(col("entrydate").isNotNull())
    sn = s.select(col("id").alias("_sid"), col("student_number"))
    hist = r.join(sn, r["studentid"] == sn["_sid"]).select(
        col("studentid"),
        col("student_number").cast("string").alias("studentNum_raw"),
        col("entrydate").alias("startDate_raw"),
        col("exitdate").alias("endDate_raw"),
        col("grade_level").alias("grade_level_raw"),
        col("schoolid").cast("long").alias("school_key"),
        F.substring(col("entrycode"), 1, 20).alias("localStartStatus_raw"),
        F.substring(col("exitcode"), 1, 20).alias("localEndStatus_raw"),
    )
    return union_tagged([(base, "STUDENTS"), (hist, "REENROLLMENTS")], tag="sourceTable_raw")


def enrolments_with_calendar(t: Tables, src: DataFrame) -> DataFrame:
    """Map each enrolment to its school and to every year-record calendar its
    date range overlaps (C06)."""
    skm = key_map(t)
    m = src.join(dimension(skm), src["school_key"] == skm["school_key"]).drop(skm["school_key"]) \
        .where(col("schoolNum").isNotNull())
    m = m.withColumn("schoolNum_str", col("schoolNum").cast("string"))
    cal = yearrec_calendars(t)
    return overlap_join(m, cal, [("schoolNum_str", "schoolNum_raw")],
                        "startDate_raw", "endDate_raw", "startDate_dt", "endDate_dt")


ENROLLMENT_COLUMNS = ["studentNum", "startDate", "gradeLevel", "schoolNum", "calendarName", "endDate",
                      "localStartStatus", "localEndStatus", "exclude", "serviceType", "noShow", "sourceTable"]


@extract("enrollment", batch=3, school="schoolNum")
def enrollment(t: Tables, p: ExtractParams) -> DataFrame:
    m = enrolments_with_calendar(t, enrolment_sources(t, p))
    x = m.select(
        clip(col("studentNum_raw"), 15).alias("studentNum"),
        col("startDate_raw").alias("startDate"),
        clip(pad_grade(col("grade_level_raw")), 20).alias("gradeLevel"),
        clip(col("schoolNum"), 7).alias("schoolNum"),
        clip(col("calendarName_raw"), 30).alias("calendarName"),
        col("endDate_raw").alias("endDate"),
        clip(col("localStartStatus_raw"), 20).alias("localStartStatus"),
        clip(col("localEndStatus_raw"), 20).alias("localEndStatus"),
        F.lit(None).cast("string").alias("exclude"),
        F.lit("P").alias("serviceType"),
        no_show(col("startDate_raw"), col("endDate_raw")).alias("noShow"),
        col("sourceTable_raw").alias("sourceTable"),
    )
    # history first, then open-ended last; remaining columns make the order total
    d = dedup_first(x, ["studentNum", "startDate", "gradeLevel", "schoolNum", "calendarName"], [
        F.when(col("sourceTable") == "REENROLLMENTS", 0).otherwise(1),
        col("endDate").asc_nulls_last(),
        col("localStartStatus").asc_nulls_last(),
        col("localEndStatus").asc_nulls_last(),
    ])
    return finalize(d, ENROLLMENT_COLUMNS,
                    required_all(["studentNum", "startDate", "gradeLevel", "schoolNum", "calendarName"]))


# PK aliases and the kindergarten code (fixed values of the grade sequence)
PK_CODES = ("PK", "PREK", "PRE-K", "P3", "P4")
K_CODE = "K"


@extract("gradeLevel", batch=1, order=("schoolNum", "calendarName", "gradeSeq"), school="schoolNum")
def grade_level(t: Tables, p: ExtractParams) -> DataFrame:
    """Distinct (school, calendar, grade) over all enrolments, also those of
    history rows whose student is gone."""
    spell = [col("entrydate").alias("startDate_raw"), col("exitdate").alias("endDate_raw"),
             col("grade_level").alias("grade_level_raw"), col("schoolid").cast("long").alias("school_key")]
    src = union_all([of_school(t, p, x, "schoolid").select(*spell) for x in (t.students, t.reenrollments)]) \
        .where(col("startDate_raw").isNotNull() & col("grade_level_raw").isNotNull())
    m = enrolments_with_calendar(t, src).where(col("schoolNum") != 999999)
    g = m.select(col("schoolNum").alias("s"), col("calendarName_raw").alias("c"),
                 col("grade_level_raw").cast("string").alias("g")).distinct()
    tg = F.trim(col("g"))
    up = F.upper(tg)
    x = g.select(
        clip(col("s"), 10).alias("schoolNum"),
        clip(col("c"), 60).alias("calendarName"),
        clip(F.lpad(tg, 2, "0"), 20).alias("gradeLevel"),
        clip(tg, 20).alias("stateGradeLevel"),
        F.when(up.isin(*PK_CODES), F.lit(4))
         .when(up == K_CODE, F.lit(5))
         .when(tg.rlike(r"^[0-9]+$"), tg.try_cast("int") + 5)
         .cast("int").alias("gradeSeq"),
    )
    return finalize(x, ["schoolNum", "calendarName", "gradeLevel", "stateGradeLevel", "gradeSeq"],
                    required_all(["schoolNum", "calendarName", "gradeLevel", "gradeSeq"]))
