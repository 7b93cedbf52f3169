"""Health extracts: the twelve alert-driven screenings (E36–E47, one factory),
the placeholder screenings/visits (E32, E34, E35) and healthCondition (E33)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, contains_any
from rollbook.operators.quality import empty_fallback, finalize, required, with_codes
from rollbook.operators.relational import dedup_first, half_open
from rollbook.params import ExtractParams
from rollbook.plans.registry import extract
from rollbook.sources.catalog import Tables

US_DATE = "MM/dd/yyyy"

# name -> (alert-description keywords, marker code).  Fixed values of each screening.
ALERT_SCREENINGS = {
    "dentalScreening": (("DENT", "ORAL", "SCREEN"), "ERR_NO_SOURCE_ROWS_FOR_DENTALSCREENING; "),
    "developmentalScreening": (("DEVELOP", "DEV SCREEN", "EARLY CHILD", "PRESCHOOL SCREEN"),
                               "ERR_NO_SOURCE_ROWS_FOR_DEVELOPMENTALSCREENING; "),
    "earlyChildhoodScreening": (("EARLY", "PRESCHOOL", "KINDERGARTEN SCREEN", "ECSE", "CHILD FIND"),
                                "ERR_NO_SOURCE_ROWS_FOR_EARLYCHILDHOODSCREENING; "),
    "hearingScreening": (("HEAR", "AUDIO", "SCREEN"), "ERR_NO_SOURCE_ROWS_FOR_HEARINGSCREENING; "),
    "healthWeightScreening": (("HEIGHT", "WEIGHT", "BMI", "PHYSICAL"),
                              "ERR_NO_SOURCE_ROWS_FOR_HEIGHTWEIGHTSCREENING; "),
    "leadScreening": (("LEAD", "PB", "SCREEN"), "ERR_NO_SOURCE_ROWS_FOR_LEADSCREENING; "),
    "scoliosisScreening": (("SCOLIO", "SPINE", "SCREEN"), "ERR_NO_SOURCE_ROWS_FOR_SCOLIOSISSCREENING; "),
    "socialEmotionalScreening": (("SOCIAL", "EMOT", "BEHAV", "SEL"),
                                 "ERR_NO_SOURCE_ROWS_FOR_SOCIALEMOTIONALSCREENING; "),
    "speechScreening": (("SPEECH", "LANGUAGE", "ARTIC", "FLUENCY"), "ERR_NO_SOURCE_ROWS_FOR_SPEECHSCREENING; "),
    "sportsScreening": (("SPORT", "ATHLET", "PHYSICAL", "CLEARANCE"), "ERR_NO_SOURCE_ROWS_FOR_SPORTSSCREENING; "),
    "tuberculosisScreening": (("TB", "TUBERC", "PPD", "MANTOUX"),
                              "ERR_NO_SOURCE_ROWS_FOR_TUBERCULOSISSCREENING; "),
    "visionScreening": (("VISION", "EYE", "SCREEN"), "ERR_NO_SOURCE_ROWS_FOR_VISIONSCREENING; "),
}


# the screenings whose script states a unique key (student, date)
KEYED_SCREENINGS = ("dentalScreening", "developmentalScreening", "earlyChildhoodScreening", "hearingScreening",
                    "healthWeightScreening", "leadScreening", "scoliosisScreening", "visionScreening")


def alert_screening(t: Tables, words, fallback_code: str):
    """Students ⋈ alerts whose description matches any keyword; the alert's
    expiry date is the screening date.  One row per matching alert.  The
    keyword filter runs on the alert side before the join."""
    a = t.psm_studentalert.where(col("dateexpires").isNotNull() & contains_any("description", words))
    s = t.students.where(col("student_number").isNotNull()).select(
        col("id").alias("_sid"), F.substring(col("student_number").cast("string"), 1, 15).alias("studentNum"))
    j = a.join(s, a["studentid"] == s["_sid"]).select("studentNum", col("dateexpires").alias("date"))
    out = finalize(j, ["studentNum", "date"],
                   [required("studentNum", blank=True), ("ERR_REQUIRED_date", col("date").isNull())])
    return empty_fallback(out, {"row_type": "ERROR", "validation_errors": fallback_code})


def _register_alerts():
    for name, (words, code) in ALERT_SCREENINGS.items():
        def fn(t, p, _w=words, _c=code):
            return alert_screening(t, _w, _c)
        fn.__name__ = name
        extract(name, batch=2, date_format=US_DATE, key=("studentNum", "date") if name in KEYED_SCREENINGS else ())(fn)


_register_alerts()


def _enrolled_in_window(t: Tables, p: ExtractParams) -> DataFrame:
    """Distinct student numbers with an enrolment starting in the visit window."""
    c = t.cc.where(col("dateenrolled").isNotNull() & half_open("dateenrolled", p.window_start, p.window_end)) \
        .select(col("studentid").alias("_cs")).distinct()
    s = t.students.where(col("student_number").isNotNull()).select(col("id"), col("student_number"))
    return s.join(c, s["id"] == c["_cs"], "left_semi").select(
        col("student_number").cast("string").alias("studentNum")).distinct()


@extract("healthVisit", batch=2, date_format=US_DATE)
def health_visit(t: Tables, p: ExtractParams) -> DataFrame:
    """The visit source is not in the SIS; every in-window student gets a
    row that fails its required fields (placeholder source over real scope)."""
    x = _enrolled_in_window(t, p).select(
        F.substring("studentNum", 1, 15).alias("studentNum"),
        F.lit(None).cast("date").alias("visitDate"),
        F.lit(None).cast("string").alias("visitTime"),
        F.lit(None).cast("string").alias("employNum"))
    out = finalize(x, ["studentNum", "visitDate", "visitTime", "employNum"],
                   [required("studentNum", blank=True), required("visitDate"),
                    required("visitTime", blank=True), required("employNum", blank=True)])
    return empty_fallback(out, {"row_type": "ERROR", "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_HEALTHVISIT;"})


@extract("childAndTeenScreening", batch=2, date_format=US_DATE)
def child_and_teen(t: Tables, p: ExtractParams) -> DataFrame:
    x = _enrolled_in_window(t, p).select(
        F.substring("studentNum", 1, 15).alias("studentNum"), F.lit(None).cast("date").alias("date"))
    out = finalize(x, ["studentNum", "date"],
                   [required("studentNum", blank=True), ("ERR_REQUIRED_date", col("date").isNull())])
    return empty_fallback(out, {"row_type": "ERROR",
                                "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_CHILDANDTEENSCREENING;"})


@extract("concussionScreening", batch=2)
def concussion(t: Tables, p: ExtractParams) -> DataFrame:
    """Every student with a termed enrolment; the date is not in the SIS,
    so each row is ERROR with the literal code (no trailing space)."""
    c = t.cc.where(col("termid").isNotNull()).select(col("studentid").alias("_cs")).distinct()
    s = t.students.where(col("student_number").isNotNull())
    x = s.join(c, s["id"] == c["_cs"], "left_semi").select(
        F.substring(col("student_number").cast("string"), 1, 15).alias("studentNum")).distinct() \
        .withColumn("date", F.lit(None).cast("date"))
    out = x.select(
        F.when(col("date").isNull(), "ERROR").otherwise("CLEAN").alias("recordType"),
        "studentNum", "date",
        with_codes(F.when(col("date").isNull(), F.lit("ERR_REQUIRED_date;")), ["ERR_REQUIRED_date"]))
    return empty_fallback(out, {"recordType": "ERROR",
                                "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_CONCUSSIONSCREENING;"})


# ---- E33 healthCondition --------------------------------------------------------------

@extract("healthCondition", batch=2, order=("studentNum", "code", "startDate"), date_format=US_DATE)
def health_condition(t: Tables, p: ExtractParams) -> DataFrame:
    hc = t.healthconcerns
    s = t.students.select(col("dcid").alias("_sdcid"), "student_number")
    j = hc.join(s, col("studentsdcid") == col("_sdcid"))
    x = j.select(
        clip(F.substring(col("student_number").cast("string"), 1, 15), 15).alias("studentNum"),
        clip(F.substring("healthconcern", 1, 10), 10).alias("code"),
        clip(F.substring("narrative", 1, 60), 60).alias("description"),
        col("startdate").alias("startDate"), col("stopdate").alias("endDate"),
        F.lit("Active").alias("status"),
        clip(F.substring(F.trim(F.coalesce(col("whocreated"), F.lit("SYS"))), 1, 10), 10).alias("initials"),
        F.lit(None).cast("string").alias("doctorName"), F.lit(None).cast("string").alias("doctorPhone"),
        F.lit(None).cast("string").alias("userWarning"), F.lit(None).cast("string").alias("instructions"))
    d = dedup_first(x, ["studentNum", "code", "startDate"],
                    [col("endDate").asc_nulls_last(), col("description").asc_nulls_last(),
                     col("initials").asc_nulls_last()])
    rules = [required("studentNum", blank=True), required("code", blank=True), required("description", blank=True),
             required("startDate"), required("status", blank=True), required("initials", blank=True)]
    out = finalize(d, ["studentNum", "code", "description", "startDate", "endDate", "status", "initials",
                       "doctorName", "doctorPhone", "userWarning", "instructions"], rules)
    return empty_fallback(out, {"row_type": "ERROR", "validation_errors": "WARN_NO_ROWS_RETURNED"})
