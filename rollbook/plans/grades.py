"""Grades and standards: transcript (E21), gradingTask (E22), gradingComment
(E23), standards (E24), studentStandardScore (E25), and the next-year
enrolment rollover (E20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, number_text, one_line, score_value
from rollbook.operators.quality import empty_fallback, finalize, required, row_type_severity
from rollbook.operators.relational import dedup_first, dimension, half_open, union_all
from rollbook.operators.years import active_year_containing
from rollbook.params import ExtractParams
from rollbook.plans.common import section_keys_in_year, section_year
from rollbook.plans.registry import extract, of_school
from rollbook.sources.catalog import Tables

US_DATE = "MM/dd/yyyy"
# fixed review text of every transcript row
TRANSCRIPT_REVIEW = "CREDITS_COLUMNS_UNKNOWN_IN_PS.STOREDGRADES"


# ---- E21 transcript ------------------------------------------------------------------

TRANSCRIPT_COLUMNS = ["studentNum", "courseNum", "courseName", "endYear", "gradeLevel", "score", "percent",
                      "creditsEarned", "creditsAttempted", "gpaWeight", "weightedGPAValue", "unweightedGPAValue",
                      "actualTerm", "additionalKey", "storedCode", "dateStored", "comments", "sourceTable",
                      "reviewReason"]
# the fields in quotes; all others are bare (fixed by the file)
TRANSCRIPT_QUOTED = ("courseName", "gradeLevel", "score", "additionalKey", "storedCode", "comments", "sourceTable",
                     "reviewReason", "validation_errors")


@extract("transcript", batch=3, order=("studentNum", "courseNum", "endYear", "actualTerm", "additionalKey"),
         quote="bare", fields=dict.fromkeys(TRANSCRIPT_QUOTED, "text"))
def transcript(t: Tables, p: ExtractParams) -> DataFrame:
    sg = t.storedgrades.where(half_open("datestored", p.window_start, p.window_end))
    st = t.students.select(col("id").alias("_sid"), "student_number")
    j = sg.join(st, col("studentid") == col("_sid"))
    x = j.select(
        clip(col("student_number").cast("string"), 15).alias("studentNum"),
        clip("course_number", 13).alias("courseNum"),
        one_line(clip("course_name", 60)).alias("courseName"),
        F.lit(p.transcript_end_year).alias("endYear"),
        one_line(clip("grade_level", 4)).alias("gradeLevel"),
        one_line(clip("grade", 10)).alias("score"),
        col("percent"),
        col("earnedcrhrs").alias("creditsEarned"),
        col("potentialcrhrs").alias("creditsAttempted"),
        F.when(col("excludefromgpa") == 1, F.lit(0)).otherwise(col("potentialcrhrs"))
         .cast("decimal(10,2)").alias("gpaWeight"),
        F.coalesce(col("gpa_addedvalue"), F.lit(0)).cast("decimal(10,2)").alias("weightedGPAValue"),
        F.lit(None).cast("decimal(10,2)").alias("unweightedGPAValue"),
        (col("termid") % 100).cast("int").alias("actualTerm"),
        one_line(clip(col("dcid").cast("string"), 50)).alias("additionalKey"),
        one_line(clip("storecode", 10)).alias("storedCode"),
        col("datestored").alias("dateStored"),
        one_line(clip(F.substring("comment_value", 1, 1200), 1200)).alias("comments"),
        F.lit("STOREDGRADES").alias("sourceTable"),
        F.lit(TRANSCRIPT_REVIEW[:50]).alias("reviewReason"),
    )
    keys = ["studentNum", "courseNum", "endYear", "actualTerm", "additionalKey"]
    rest = [c for c in TRANSCRIPT_COLUMNS if c not in keys]
    d = dedup_first(x, keys, [col(c).asc_nulls_last() for c in rest])
    rules = [required("studentNum", blank=True), required("courseNum", blank=True), required("endYear"),
             required("gradeLevel", blank=True), required("score", blank=True), required("creditsEarned"),
             required("creditsAttempted"), required("additionalKey", blank=True)]
    return finalize(d, TRANSCRIPT_COLUMNS, rules)


# ---- E22 gradingTask ------------------------------------------------------------------

# store-code families (fixed values)
FINAL_GRADE_CODES = ("Y", "Y1", "Y2")
FINAL_EXAM_CODES = ("F", "F1", "FE")
PROGRESS_CODES = ("P", "PR")
TRANSCRIPT_CODES = ("Y", "Y1", "Y2", "S1", "S2")


@extract("gradingTask", batch=3, order=("taskSeq", "taskName", "taskCode"), quote="bare",
         fields={"taskName": "text", "taskCode": "optional", "sourceStoreCode": "optional", "validation_errors": "text"})
def grading_task(t: Tables, p: ExtractParams) -> DataFrame:
    """One task per distinct store code."""
    sc = t.storedgrades.where(col("storecode").isNotNull()
                              & (F.length(F.regexp_replace("storecode", r"\s", "")) > 0)) \
        .select(F.substring(F.trim("storecode"), 1, 25).alias("storeCode")).distinct()
    u = F.upper("storeCode")
    digit = F.substring("storeCode", 2, 1)
    is_q, is_s = u.rlike("^Q[1-9]$"), u.rlike("^S[1-9]$")
    name = (F.when(is_q, F.concat(F.lit("Quarter "), digit, F.lit(" Grade")))
            .when(is_s, F.concat(F.lit("Semester "), digit, F.lit(" Grade")))
            .when(u.isin(*FINAL_GRADE_CODES), F.lit("Final Grade"))
            .when(u.isin(*FINAL_EXAM_CODES), F.lit("Final Exam"))
            .when(u.isin(*PROGRESS_CODES), F.lit("Progress"))
            .otherwise(col("storeCode")))
    seq = (F.when(is_q, digit.cast("int")).when(is_s, 10 + digit.cast("int"))
           .when(u.isin(*FINAL_GRADE_CODES), F.lit(99)).otherwise(F.lit(500)))
    x = sc.select(
        one_line(clip(name, 75)).alias("taskName"),
        one_line(clip(F.substring("storeCode", 1, 25), 25)).alias("taskCode"),
        seq.cast("int").alias("taskSeq"),
        F.when(u.isin(*TRANSCRIPT_CODES), 1).otherwise(0).alias("postToTranscript"),
        one_line(col("storeCode")).alias("sourceStoreCode"))
    out = finalize(x, ["taskName", "taskCode", "taskSeq", "postToTranscript", "sourceStoreCode"],
                   [required("taskName", blank=True)])
    return empty_fallback(out, {"row_type": "ERROR", "taskName": "MISSING_SOURCE_TASKS", "taskSeq": 999,
                                "postToTranscript": 0,
                                "validation_errors": "ERR_NO_STORECODES_IN_PS.STOREDGRADES; "})


# ---- E23 gradingComment ----------------------------------------------------------------

COMMENT_WIDTH = 200


@extract("gradingComment", batch=2)
def grading_comment(t: Tables, p: ExtractParams) -> DataFrame:
    """Three comment sources, de-duplicated on the first 200 characters of the
    trimmed comment.  Section and rollup comments are whole documents; the key
    is a prefix by the extract's own rule, the kept text is the same prefix."""
    def nonblank(df, c):
        return df.where(col(c).isNotNull() & (F.trim(c) != "")).select(col(c).alias("comment_raw"))
    sec = nonblank(t.standardgradesectioncomment, "commentvalue")
    rollup = nonblank(t.standardgraderollupcomment, "commentvalue")
    y = active_year_containing(t.terms, p.as_of_date).scalar()
    terms = t.terms.where(col("yearid") == y).select(col("id").alias("_tid"), col("schoolid").alias("_tsch"))
    sg = t.storedgrades.join(dimension(terms), (col("termid") == col("_tid")) & (col("schoolid") == col("_tsch")),
                             "left_semi")
    sgc = nonblank(sg, "comment_value")
    src = union_all([sec, rollup, sgc])
    # the partition key *is* the kept text, so one pre-aggregated row per key suffices
    g = src.select(F.substring(F.trim("comment_raw"), 1, COMMENT_WIDTH).alias("comment")).distinct()
    x = g.select(F.lit(None).cast("string").alias("schoolNum"), F.lit(None).cast("string").alias("code"),
                 one_line(F.nullif(col("comment"), F.lit(""))).alias("comment"))
    out = finalize(x, ["schoolNum", "code", "comment"], [required("comment", blank=True)])
    return empty_fallback(out, {"row_type": "ERROR", "comment": "NO_COMMENTS_FOUND",
                                "validation_errors": "WARN_NO_ROWS_RETURNED"})


# ---- E24 standards --------------------------------------------------------------------

STANDARD_COLUMNS = ["standardid", "parentstandardid", "longitudinalid", "yearid", "name", "description",
                    "identifier", "subjectarea", "conversionscale", "gradescaleitemdcid", "isassignmentallowed",
                    "isactive", "deactivatedate", "displayposition", "iscommentincluded", "maxcommentlength",
                    "isexcludedfromreports", "importbatchtracking", "psguid", "whocreated", "whencreated",
                    "whomodified", "whenmodified", "transientcourselist", "externalid", "parentstandardid_nvl"]


@extract("standards", batch=2, quote="bare", date_format="yyyy-MM-dd HH:mm:ss", fields=dict.fromkeys([c.upper() for c in STANDARD_COLUMNS], "stored"))
def standards(t: Tables, p: ExtractParams) -> DataFrame:
    """Pass-through: every standard exactly as stored (no cut, no de-dup).
    Timestamps are carried as wall-clock values (timestamp_ntz)."""
    std = t.standard

    def as_stored(c):
        ty = std.schema[c].dataType.simpleString()
        return col(c).cast("timestamp_ntz") if ty == "timestamp" else col(c)
    return std.select(F.lit("CLEAN").alias("recordType"), *[as_stored(c).alias(c.upper()) for c in STANDARD_COLUMNS])


# ---- E25 studentStandardScore ------------------------------------------------------------

@extract("studentStandardScore", batch=3)
def student_standard_score(t: Tables, p: ExtractParams) -> DataFrame:
    ss = t.standardscore
    asa = t.assignmentstandardassoc.select(col("assignmentstandardassocid").alias("_asa"), "standardid")
    st = t.students.where(col("student_number").isNotNull()).select(col("dcid").alias("_sdcid"), "student_number")
    j = ss.join(asa, col("assignmentstandardassocid") == col("_asa")).join(st, col("studentsdcid") == col("_sdcid"))
    x = j.select(
        F.substring(col("student_number").cast("string"), 1, 20).alias("studentNumber"),
        col("standardid").alias("standardID"),
        col("yearid").alias("yearID"),
        score_value(col("actualscoreentered"), col("scorelettergrade"), number_text("scorenumericgrade"),
                    number_text("scorepercent")).alias("gradeValue"))
    rules = [("ERR_REQUIRED_studentNumber", col("studentNumber").isNull()),
             ("ERR_REQUIRED_standardID", col("standardID").isNull()),
             ("ERR_REQUIRED_gradeValue", col("gradeValue").isNull())]
    return finalize(x, ["studentNumber", "standardID", "yearID", "gradeValue"], rules, type_col="record_status")


# ---- E20 next-year enrolment rollover ------------------------------------------------------

# fixed note written on every rollover row
ROLLOVER_NOTE = ("TRIAL_ONLY_PSEUDO_ROLLOVER_26_27: Derived from Students.NEXT_SCHOOL (treated as Schools.school_number) "
                 "and Students.SCHED_NEXTYEARGRADE. Excludes NEXT_SCHOOL in (0, 999999). "
                 "Calendar dates pulled from Terms for target year using resolved school; NULL dates require district cleanup.")
ROLLOVER_FATAL = ("ERR_REQUIRED_schoolNum_from_NEXT_SCHOOL", "ERR_REQUIRED_studentNum")


@extract("2627Enrollment", batch=3, order=("studentNum", "schoolNum"), date_format=US_DATE, school="schoolNum")
def next_year_enrollment(t: Tables, p: ExtractParams) -> DataFrame:
    """Students enrolled in the newest section year who continue next year,
    with the next school's calendar span (J16 as one left join to a grouped frame)."""
    y = section_year(t)
    secs = section_keys_in_year(t, y).select(col("id").alias("_secid"))
    active_ids = t.cc.select("studentid", "sectionid").join(secs, col("sectionid") == col("_secid"), "left_semi") \
        .select(col("studentid").alias("_aid")).distinct()
    st = of_school(t, p, t.students, "next_school").where(col("student_number").isNotNull() & (col("student_number") != 0)) \
        .join(active_ids, col("id") == col("_aid"), "left_semi") \
        .where((col("enroll_status") == 0) & col("next_school").isNotNull() & ~col("next_school").isin(0, 999999))
    sch = t.schools.select(col("school_number").alias("_nsn"), col("id").alias("next_schoolid"))
    span = t.terms.where(col("yearid") == y + 1).groupBy(col("schoolid").alias("_span_sch")) \
        .agg(F.min("firstday").alias("year_firstday"), F.max("lastday").alias("year_lastday"))
    j = (st.join(dimension(sch), col("next_school") == col("_nsn"), "left")
         .join(dimension(span), col("next_schoolid") == col("_span_sch"), "left"))
    x = j.select(
        clip(col("student_number").cast("string"), 15).alias("studentNum"),
        clip(col("_nsn").cast("string"), 20).alias("schoolNum"),
        clip(F.trim(col("sched_nextyeargrade").cast("string")), 20).alias("grade"),
        col("year_firstday").alias("startDate"), col("year_lastday").alias("endDate"),
        F.lit("Active").alias("enrollmentStatus"),
        F.lit(ROLLOVER_NOTE[:255]).alias("comments"),
        F.lit(None).cast("int").alias("exclude"))
    rules = [required("studentNum", blank=True),
             ("ERR_REQUIRED_schoolNum_from_NEXT_SCHOOL", x["schoolNum"].isNull()),
             ("WARN_MISSING_SCHED_NEXTYEARGRADE", x["grade"].isNull()),
             ("WARN_MISSING_26_27_calendar_startDate", x["startDate"].isNull()),
             ("WARN_MISSING_26_27_calendar_endDate", x["endDate"].isNull())]
    return finalize(x, ["studentNum", "schoolNum", "grade", "startDate", "endDate", "enrollmentStatus", "comments",
                        "exclude"], rules, type_col="record_status",
                    type_expr=row_type_severity("validation_errors", ROLLOVER_FATAL))
