"""Schools, calendars and schedules.

All frames here are dimensions (schools x years x a few codes) except the
roster and course-request extracts, which read ``cc``; those join the
enrolment side to broadcast dimensions only, so ``cc`` is scanned once and
never shuffled for a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, default_phone, first_nonblank, hhmm
from rollbook.operators.quality import Rows, finalize, required, rule
from rollbook.operators.relational import (
    count_in_group, dedup_first, dimension, drop_sentinels, half_open, school_key_map, sequence_in_group, union_all)
from rollbook.operators.years import (
    active_year_containing, calendar_name_span, calendar_name_start)
from rollbook.params import ExtractParams
from rollbook.plans.common import section_keys_in_year, section_year
from rollbook.plans.registry import extract, of_school
from rollbook.sources.catalog import Tables

US_DATE = "MM/dd/yyyy"
SENTINEL = 999999
SUMMER_MONTHS = (6, 7)


def number_map(t: Tables) -> DataFrame:
    """1-key map (school_number only), as the schedule extracts use."""
    return school_key_map(t.schools, keys=("school_number",))


# ---- E01 school -------------------------------------------------------------------

# By row type, then by the number inside the school number text
@extract("school", batch=1, order=("row_type", r"expr:try_cast(regexp_extract(schoolNum, '\\d+', 0) as bigint)",
                                   "schoolNum"), school="schoolNum")
def school(t: Tables, p: ExtractParams) -> DataFrame:
    s = drop_sentinels(of_school(t, p, t.schools, "school_number"), "school_number", bad=(SENTINEL,))
    s = s.select(
        F.substring(col("school_number").cast("string"), 1, 10).alias("schoolNum_raw"),
        F.substring(col("alternate_school_number").cast("string"), 1, 10).alias("stateSchoolNum_raw"),
        F.substring(col("name"), 1, 100).alias("name_raw"),
        F.substring(F.trim(col("schoolphone")), 1, 25).alias("phone_raw"),
        col("schoolcity"), col("schoolstate"), col("schoolzip"),
        F.substring(F.trim(col("schoolfax")), 1, 25).alias("fax_raw"),
        F.substring(F.trim(col("principal")), 1, 100).alias("principal_raw"),
        F.substring(F.trim(col("principalemail")), 1, 100).alias("email_raw"),
    )
    d = dedup_first(s, ["schoolNum_raw"], [col("name_raw").asc_nulls_last(), col("stateSchoolNum_raw").asc_nulls_last()])
    x = d.select(
        clip("schoolNum_raw", 10).alias("schoolNum"),
        clip("stateSchoolNum_raw", 10).alias("stateSchoolNum"),
        clip("name_raw", 100).alias("name"),
        default_phone("phone_raw", 25).alias("phone"),
        F.lit(None).cast("string").alias("address"),
        clip("schoolcity", 50).alias("city"),
        clip("schoolstate", 2).alias("state"),
        clip("schoolzip", 10).alias("zip"),
        clip("fax_raw", 25).alias("fax"),
        clip("principal_raw", 100).alias("principalName"),
        clip("email_raw", 100).alias("principalEmail"),
        F.lit("Course Catalog").alias("courseCatalog"),
    )
    cols = ["schoolNum", "stateSchoolNum", "name", "phone", "address", "city", "state", "zip", "fax",
            "principalName", "principalEmail", "courseCatalog"]
    return finalize(x, cols, [required("schoolNum", blank=True), required("name", blank=True)])


# ---- E02 calendar -------------------------------------------------------------------

@extract("calendar", batch=1, order=("schoolNum", "startDate"), school="schoolNum")
def calendar(t: Tables, p: ExtractParams) -> DataFrame:
    skm = school_key_map(t.schools, extra=(F.coalesce(col("issummerschool"), F.lit(0)).alias("isSummerSchool"),))
    terms = of_school(t, p, t.terms, "schoolid").where(col("isyearrec") == 1)
    y = terms.join(dimension(skm), terms["schoolid"] == skm["school_key"]) \
        .where(col("schoolNum").isNotNull() & (col("schoolNum") != SENTINEL))
    x = y.select(
        F.substring(F.trim(col("schoolNum").cast("string")), 1, 7).alias("schoolNum"),
        calendar_name_start(col("firstday"), col("schoolName"), strip_digits=True).alias("calendarName"),
        col("firstday").alias("startDate"),
        col("lastday").alias("endDate"),
        F.floor(col("id") / 100).cast("long").alias("calendarNumber"),
        F.lit(1).alias("sequence"),
        (F.year("firstday") + 1).alias("schoolYear"),
        col("isSummerSchool").cast("int").alias("summerSchool"),
    )
    rules = [required("schoolNum"), required("calendarName"), required("startDate"), required("endDate"),
             rule("ERR_INVALID_dateRange", col("startDate") > col("endDate"))]
    return finalize(x, ["schoolNum", "calendarName", "startDate", "endDate", "calendarNumber", "sequence",
                        "schoolYear", "summerSchool"], rules)


# ---- E04 term ---------------------------------------------------------------------

def active_or_upcoming_years(terms: DataFrame, as_of) -> DataFrame:
    """C04d: yearids of year records that contain ``as_of``, or are a future
    summer, or start the next fall (earliest future start in month >= 7).
    AND binds tighter than OR in the source rule: A OR (B AND C) OR D."""
    d = F.lit(as_of).cast("date")
    yr = terms.where(col("isyearrec") == 1)
    next_start = yr.where((col("firstday") > d) & (F.month("firstday") >= 7)) \
        .agg(F.min("firstday").alias("m")).scalar()
    cond = (((col("firstday") <= d) & (col("lastday") >= d))
            | (F.month("firstday").isin(*SUMMER_MONTHS) & (col("firstday") > d))
            | (col("firstday") == next_start))
    return yr.where(cond).select("yearid").distinct()


def summer_aware_name(first: Column, last: Column, school_name: Column) -> Column:
    """June/July starts are ``YY-YY Summer School``; others ``YY-YY <school>``."""
    yy = F.concat_ws("", F.substring(F.year(first).cast("string"), -2, 2), F.lit("-"),
                     F.substring(F.year(last).cast("string"), -2, 2))
    return F.when(F.month(first).isin(*SUMMER_MONTHS), F.concat_ws("", yy, F.lit(" Summer School"))) \
        .otherwise(F.concat_ws("", yy, F.lit(" "), F.substring(F.trim(school_name), 1, 23)))


@extract("term", batch=1, school="schoolNum")
def term(t: Tables, p: ExtractParams) -> DataFrame:
    skm = school_key_map(t.schools)
    years = active_or_upcoming_years(t.terms, p.as_of_date)
    terms = of_school(t, p, t.terms, "schoolid").join(dimension(years).withColumnRenamed("yearid", "_ay"),
                         col("yearid") == col("_ay"), "left_semi")
    yr = terms.where(col("isyearrec") == 1).join(dimension(skm), col("schoolid") == col("school_key")) \
        .where(col("schoolNum").isNotNull() & (col("schoolNum") != SENTINEL))
    cal = yr.select(col("schoolNum").alias("_cs"),
                    F.substring(summer_aware_name(col("firstday"), col("lastday"), col("schoolName")), 1, 30)
                    .alias("calendarName_raw"))
    # terms are joined to calendars by school only (every active calendar of the school)
    at = (terms.where(F.coalesce(col("isyearrec"), F.lit(0)) == 0)
          .join(dimension(skm), col("schoolid") == col("school_key"))
          .where(col("schoolNum").isNotNull())
          .join(dimension(cal), col("schoolNum") == col("_cs")))
    at = at.select(col("schoolNum").alias("schoolNum_raw"), "calendarName_raw",
                   F.substring("name", 1, 30).alias("termName_raw"), "firstday", "lastday", col("id").alias("termid"))
    d = dedup_first(at, ["schoolNum_raw", "calendarName_raw", "termName_raw"],
                    [col("termid").asc(), col("firstday").asc(), col("lastday").asc()])
    x = d.select(
        clip(col("schoolNum_raw"), 7).alias("schoolNum"),
        clip("calendarName_raw", 30).alias("calendarName"),
        clip("termName_raw", 30).alias("termName"),
        F.date_format("firstday", "MM/dd/yyyy").alias("startDate"),
        F.date_format("lastday", "MM/dd/yyyy").alias("endDate"),
    )
    return finalize(x, ["schoolNum", "calendarName", "termName", "startDate", "endDate"],
                    [required(c) for c in ("schoolNum", "calendarName", "termName", "startDate", "endDate")])


# ---- E07 department / E08 room -------------------------------------------------------

@extract("department", batch=1, key=("schoolNum", "departmentName"), refs=(("schoolNum", "school", "schoolNum"),),
         school="schoolNum")
def department(t: Tables, p: ExtractParams):
    """Departments of the courses that have a section in the newest section year; the (school,
    course) pairs are reduced before they meet the courses."""
    keys = section_keys_in_year(t, section_year(t)).select("schoolid", "course_number")
    c = t.courses.where(col("sched_department").isNotNull() & (F.trim("sched_department") != "")).select(
        col("course_number").alias("_cn"), "sched_department")
    d = (of_school(t, p, keys, "schoolid").distinct().join(c, col("course_number") == col("_cn"))
         .join(dimension(school_key_map(t.schools)), col("schoolid") == col("school_key"), "left")
         .select(F.substring(col("schoolNum").cast("string"), 1, 7).alias("schoolNum_raw"),
                 F.substring(F.trim("sched_department"), 1, 50).alias("departmentName_raw"))
         .distinct())
    # 'General' for every school when no course carries a department (fixed value)
    general = t.schools.where(col("school_number").isNotNull()).select(
        F.substring(col("school_number").cast("string"), 1, 7).alias("schoolNum_raw"),
        F.lit("General").alias("departmentName_raw"))

    def final(src):
        x = src.select(clip("schoolNum_raw", 7).alias("schoolNum"), clip("departmentName_raw", 50).alias("departmentName"))
        return finalize(x, ["schoolNum", "departmentName"],
                        [required("schoolNum", blank=True), required("departmentName", blank=True)])
    # the defaults stand for departments that no school has, also in the run of one school
    anywhere = keys.join(c, col("course_number") == col("_cn"), "left_semi") if p.school_id is not None else None
    return Rows(final(d), final(general), anywhere)


# fixed placeholder room name; the 20-character column cuts it
UNKNOWN_ROOM = "UNKNOWN_FIX_IN_POWERSCHOOL"


@extract("room", batch=1, order=("schoolNum", "roomNumber"), key=("roomNumber", "schoolNum"),
         refs=(("schoolNum", "school", "schoolNum"),), school="schoolNum")
def room(t: Tables, p: ExtractParams):
    """Rooms of the sections of the newest section year, from the schedule and from the section itself."""
    skm = dimension(school_key_map(t.schools).where(col("schoolNum").isNotNull()))
    everywhere = section_keys_in_year(t, section_year(t)).select("id", "schoolid", "room")
    ss = t.schedulesections.select(col("id").alias("_ssid"), col("room").alias("_ssroom")).where(
        F.length(F.trim("_ssroom")) > 0)

    def named(keys):
        return union_all([
            keys.join(ss, col("id") == col("_ssid")).select("schoolid", F.trim("_ssroom").alias("room")),
            keys.where(F.length(F.trim("room")) > 0).select("schoolid", F.trim("room").alias("room"))])

    rooms = (named(of_school(t, p, everywhere, "schoolid")).distinct().join(skm, col("schoolid") == col("school_key"))
             .select(F.substring("room", 1, 20).alias("roomNumber_raw"),
                     F.substring(col("schoolNum").cast("string"), 1, 7).alias("schoolNum_raw")).distinct())
    default = t.schools.select(F.lit(UNKNOWN_ROOM[:20]).alias("roomNumber_raw"),
                               F.substring(col("school_number").cast("string"), 1, 7).alias("schoolNum_raw"))

    def final(src):
        x = src.select(clip("roomNumber_raw", 20).alias("roomNumber"), clip("schoolNum_raw", 7).alias("schoolNum"))
        return finalize(x, ["roomNumber", "schoolNum"],
                        [required("roomNumber", blank=True), required("schoolNum", blank=True)])
    anywhere = named(everywhere).join(skm, col("schoolid") == col("school_key")) if p.school_id is not None else None
    return Rows(final(rooms), final(default), anywhere)


# ---- E09 course ------------------------------------------------------------------

def _active_yearrec_calendars(t: Tables, y: Column, exclude_sentinel: bool = False) -> DataFrame:
    """Year records of yearid ``y`` keyed by school number, ``YY-YY <school>``."""
    skm = number_map(t)
    yr = t.terms.where((col("isyearrec") == 1) & (col("yearid") == y)) \
        .join(dimension(skm), col("schoolid") == col("school_key")).where(col("schoolNum").isNotNull())
    if exclude_sentinel:
        yr = yr.where(col("schoolNum") != SENTINEL)
    return yr


@extract("course", batch=1, school="schoolNum")
def course(t: Tables, p: ExtractParams) -> DataFrame:
    y = active_year_containing(t.terms, p.as_of_date).scalar()
    skm = number_map(t)
    cal = _active_yearrec_calendars(t, y).select(
        col("schoolNum").alias("_cs"), calendar_name_span("firstday", "lastday", "schoolName").alias("calendarName"))
    ty = t.terms.where(col("yearid") == y).select(col("id").alias("_tid"), col("schoolid").alias("_tsch"))
    act = (of_school(t, p, t.sections, "schoolid").where(col("course_number").isNotNull())
           .join(dimension(ty), (col("termid") == col("_tid")) & (col("schoolid") == col("_tsch")), "left_semi")
           .join(dimension(skm), col("schoolid") == col("school_key"))
           .where(col("schoolNum").isNotNull())
           .select(col("schoolNum").alias("schoolNum_raw"), col("course_number").alias("courseNumber_raw"))
           .distinct())
    c = t.courses.select(col("course_number").alias("_cn"), "course_name")
    j = act.join(c, col("courseNumber_raw") == col("_cn")).join(dimension(cal), col("schoolNum_raw") == col("_cs"))
    x = j.select(
        clip(col("schoolNum_raw"), 7).alias("schoolNum"),
        clip("calendarName", 30).alias("calendarName"),
        clip("_cn", 20).alias("courseNum"),
        clip("course_name", 100).alias("courseName"),
        F.lit(None).cast("string").alias("subject"),
        F.lit(None).cast("string").alias("credit"),
        F.lit(None).cast("int").alias("exclude"),
        F.lit(1).alias("addToCatalog"),
    )
    rules = [("ERR_REQUIRED_schoolNum", col("schoolNum").isNull()),
             ("ERR_REQUIRED_calendarName", col("calendarName").isNull()),
             ("ERR_REQUIRED_courseNumber", col("courseNum").isNull()),
             ("ERR_REQUIRED_courseName", col("courseName").isNull())]
    return finalize(x, ["schoolNum", "calendarName", "courseNum", "courseName", "subject", "credit", "exclude",
                        "addToCatalog"], rules)


# ---- E10 section ------------------------------------------------------------------

@extract("section", batch=2, school="schoolNum")
def section(t: Tables, p: ExtractParams) -> DataFrame:
    y = active_year_containing(t.terms, p.as_of_date).scalar()
    skm = number_map(t)
    yr = _active_yearrec_calendars(t, y).where(col("schoolNum") != SENTINEL)
    base = yr.select("schoolNum", col("schoolid").alias("_cal_sch"),
                     summer_aware_name(col("firstday"), col("lastday"), col("schoolName")).alias("base"))
    # C05d: a name shared by several calendars gets '-<schoolNum>' and stays within 30 characters
    named = base.withColumn("_ct", count_in_group(["base"]))
    sn = col("schoolNum").cast("string")
    cal = named.select(
        "_cal_sch",
        F.when(col("_ct") == 1, F.substring("base", 1, 30))
         .otherwise(F.concat(F.expr("substring(base, 1, 30 - (1 + length(cast(schoolNum as string))))"),
                             F.lit("-"), sn)).alias("calendarName_raw"))
    ty = t.terms.where(col("yearid") == y).select(col("id").alias("_tid"), col("schoolid").alias("_tsch"))
    act = (of_school(t, p, t.sections, "schoolid").join(dimension(ty), (col("termid") == col("_tid")) & (col("schoolid") == col("_tsch")), "left_semi")
           .select("section_number", "course_number", "schoolid", "teacher", "room", "maxenrollment", "team")
           .distinct())
    staff = t.schoolstaff.select(col("users_dcid").alias("_ud"), col("schoolid").alias("_us"))
    users = t.users.select(col("dcid").alias("_udcid"), "teachernumber")
    j = (act.join(dimension(skm), col("schoolid") == col("school_key"))
         .join(dimension(cal), col("schoolid") == col("_cal_sch"))
         .join(staff, (col("_ud") == col("teacher")) & (col("_us") == col("schoolid")), "left")
         .join(users, col("_udcid") == col("_ud"), "left"))
    src = j.select(
        col("section_number").cast("string").alias("sectionNumber_raw"),
        F.trim("course_number").alias("courseNumber_raw"),
        col("schoolNum").cast("string").alias("schoolNum_raw"),
        "calendarName_raw", col("room").alias("roomNumber_raw"), col("teachernumber").alias("teacherNumber_raw"),
        col("maxenrollment").alias("maxEnrollment_raw"), col("team").alias("team_raw")).distinct()
    x = src.select(
        clip("sectionNumber_raw", 20).alias("sectionNum"),
        clip("courseNumber_raw", 20).alias("courseNum"),
        clip("schoolNum_raw", 7).alias("schoolNum"),
        clip("calendarName_raw", 30).alias("calendarName"),
        clip("roomNumber_raw", 20).alias("roomNumber"),
        col("teacherNumber_raw").alias("primaryEmployNum"),
        col("maxEnrollment_raw").alias("maxStudents"),
        clip("team_raw", 20).alias("teamName"),
        F.lit(None).cast("int").alias("exclude"),
    )
    rules = [("ERR_REQUIRED_sectionNumber", col("sectionNum").isNull()),
             ("ERR_REQUIRED_courseNumber", col("courseNum").isNull()),
             ("ERR_REQUIRED_schoolNum", col("schoolNum").isNull()),
             ("ERR_REQUIRED_calendarName", col("calendarName").isNull())]
    return finalize(x, ["sectionNum", "courseNum", "schoolNum", "calendarName", "roomNumber", "primaryEmployNum",
                        "maxStudents", "teamName", "exclude"], rules)


# ---- E05 periodSchedule / E06 period / E11 sectionSchedule ---------------------------------

# calendars excluded from schedules (fixed pattern)
NON_SCHEDULE_CALENDARS = r"(summer| ss|camp|edventure|home school|non-public|non public)"


def _window_yearrecs(t: Tables, p: ExtractParams, exclude_names: bool = False) -> DataFrame:
    skm = drop_sentinels(number_map(t), "schoolNum", bad=(SENTINEL,))
    yr = of_school(t, p, t.terms, "schoolid").where(
        (col("isyearrec") == 1) & half_open("firstday", p.year_window_start, p.year_window_end))
    if exclude_names:
        yr = yr.where(~F.lower(col("name")).rlike(NON_SCHEDULE_CALENDARS))
    return yr.join(dimension(skm), col("schoolid") == col("school_key")).select(
        "schoolNum", "schoolName", col("id").alias("year_termid"), "yearid", "firstday", "lastday", "schoolid",
        calendar_name_span("firstday", "lastday", "schoolName").alias("calendarName"))


def _schedule_pairs(t: Tables, yr: DataFrame) -> DataFrame:
    """Distinct in-session (school, cycle day, bell schedule) inside a year record."""
    cd = t.calendar_day.where((col("insession") == 1) & col("cycle_day_id").isNotNull()
                              & col("bell_schedule_id").isNotNull())
    w = yr.select(col("schoolid").alias("_ys"), col("firstday").alias("_yf"), col("lastday").alias("_yl"))
    return (cd.join(dimension(w), (col("schoolid") == col("_ys")) & col("date_value").between(col("_yf"), col("_yl")))
            .select(col("schoolid").alias("_ps"), col("cycle_day_id").alias("_pcd"),
                    col("bell_schedule_id").alias("_pbs")).distinct())


def _cycle_day_map(t: Tables, with_abbreviation: bool = True) -> DataFrame:
    skm = drop_sentinels(number_map(t), "schoolNum", bad=(SENTINEL,))
    names = [col("day_name"), col("letter")] + ([col("abbreviation")] if with_abbreviation else [])
    return t.cycle_day.join(dimension(skm), col("schoolid") == col("school_key")).select(
        col("schoolNum").alias("_cs"), col("year_id").alias("_cy"), col("id").alias("_cid"),
        col("letter").alias("_cletter"),
        first_nonblank(*names, default=F.concat_ws("", F.lit("Day "), col("day_number").cast("string")))
        .alias("scheduleName"))


@extract("periodSchedule", batch=2, school="schoolNum")
def period_schedule(t: Tables, p: ExtractParams) -> DataFrame:
    yr = _window_yearrecs(t, p, exclude_names=True)
    pairs = _schedule_pairs(t, yr)
    cdm = _cycle_day_map(t)
    j = (yr.join(pairs, col("schoolid") == col("_ps"))
         .join(cdm, (col("_cs") == col("schoolNum")) & (col("_cy") == col("yearid")) & (col("_cid") == col("_pcd"))))
    x = j.select(col("schoolNum").cast("string").alias("schoolNum"), "calendarName", "scheduleName",
                 sequence_in_group(["schoolNum", "calendarName"], [col("scheduleName").asc()]).alias("scheduleSeq"))
    return x.select(F.lit("CLEAN").alias("row_type"), "schoolNum", "calendarName", "scheduleName", "scheduleSeq",
                    F.lit(None).cast("string").alias("validation_errors"))


@extract("period", batch=2, school="schoolNum")
def period(t: Tables, p: ExtractParams) -> DataFrame:
    yr = _window_yearrecs(t, p)
    pairs = _schedule_pairs(t, yr)
    cdm = _cycle_day_map(t)
    skm = drop_sentinels(number_map(t), "schoolNum", bad=(SENTINEL,))
    pt = t.period.join(dimension(skm), col("schoolid") == col("school_key")).select(
        col("schoolid").alias("_pts"), col("id").alias("_pid"), col("period_number").alias("periodSeq"),
        first_nonblank("abbreviation", "name", default=F.concat_ws("", F.lit("P"), col("period_number").cast("string")))
        .alias("periodName"))
    years = yr.select(col("yearid").alias("_yy")).distinct()
    bt = (t.bell_schedule.join(dimension(years), col("year_id") == col("_yy"), "left_semi")
          .join(t.bell_schedule_items, col("id") == col("bell_schedule_id"))
          .select(col("schoolid").alias("_bs"), col("year_id").alias("_by"), col("period_id").alias("_bp"),
                  col("bell_schedule_id").alias("_bb"),
                  hhmm("start_time").alias("startTime"), hhmm("end_time").alias("endTime")))
    j = (yr.join(pairs, col("schoolid") == col("_ps"))
         .join(cdm, (col("_cs") == col("schoolNum")) & (col("_cy") == col("yearid")) & (col("_cid") == col("_pcd")))
         .join(pt, col("_pts") == col("schoolid"))
         .join(bt, (col("_bs") == col("schoolid")) & (col("_by") == col("yearid")) & (col("_bp") == col("_pid"))
               & (col("_bb") == col("_pbs"))))
    return j.select(F.lit("CLEAN").alias("row_type"), col("schoolNum").cast("string").alias("schoolNum"),
                    "calendarName", "scheduleName", "periodName", "periodSeq", "startTime", "endTime",
                    F.lit(None).cast("string").alias("validation_errors"))


@extract("sectionSchedule", batch=2, school="schoolNum")
def section_schedule(t: Tables, p: ExtractParams) -> DataFrame:
    yr = _window_yearrecs(t, p)
    cal = yr.select(col("schoolid").alias("_cal_sch"), "calendarName")
    years = yr.select(col("yearid").alias("_yy")).distinct()
    cdm = _cycle_day_map(t, with_abbreviation=False).join(dimension(years), col("_cy") == col("_yy"), "left_semi")
    terms = t.terms.where((col("isyearrec") == 1) & half_open("firstday", p.year_window_start, p.year_window_end)) \
        .select(col("id").alias("_tid"), col("schoolid").alias("_tsch"), col("name").alias("termName"),
                col("yearid").alias("_ty"))
    st = of_school(t, p, t.sections, "schoolid").join(dimension(terms), (col("termid") == col("_tid")) & (col("schoolid") == col("_tsch")))
    skm = drop_sentinels(number_map(t), "schoolNum", bad=(SENTINEL,))
    sm = t.section_meeting.select(col("sectionid").alias("_msec"), "period_number", "cycle_day_letter")
    j = (st.join(dimension(skm), col("schoolid") == col("school_key"))
         .join(dimension(cal), col("_cal_sch") == col("schoolid"))
         .join(sm, col("_msec") == col("id"))
         .join(dimension(cdm), (col("_cs") == col("schoolNum")) & (col("_cy") == col("_ty"))
               & (col("_cletter") == col("cycle_day_letter"))))
    pname = F.concat_ws("", F.lit("P"), col("period_number").cast("string"))
    return j.select(F.lit("CLEAN").alias("row_type"), col("schoolNum").cast("string").alias("schoolNum"),
                    "calendarName", col("course_number").alias("courseNum"),
                    col("section_number").cast("string").alias("sectionNum"),
                    col("termName").alias("startTermName"), col("termName").alias("endTermName"), "scheduleName",
                    pname.alias("startPeriodName"), pname.alias("endPeriodName"),
                    F.lit(None).cast("string").alias("exclude"), F.lit(None).cast("string").alias("validation_errors"))


# ---- E12 roster / E13 courseRequest ---------------------------------------------------

@extract("roster", batch=2, order=("sectionNum", "studentNum", "startDate"), date_format=US_DATE, school="schoolNum")
def roster(t: Tables, p: ExtractParams) -> DataFrame:
    """Dropped enrolments (negative section id) and re-enrolments stay as own rows."""
    yr = _window_yearrecs(t, p).where(col("schoolNum") != SENTINEL)
    cal = yr.select(col("schoolid").alias("_cal_sch"), col("firstday").alias("_cf"), col("lastday").alias("_cl"),
                    "calendarName")
    terms = t.terms.where((col("isyearrec") == 1) & half_open("firstday", p.year_window_start, p.year_window_end)) \
        .select(col("id").alias("_tid"), col("schoolid").alias("_tsch"))
    act = of_school(t, p, t.sections, "schoolid").join(dimension(terms), (col("termid") == col("_tid")) & (col("schoolid") == col("_tsch")),
                          "left_semi").where(col("section_number").isNotNull()) \
        .select(col("id").alias("_secid"), "section_number", "course_number", col("schoolid").alias("_secsch"))
    c = t.cc.where(col("studentid").isNotNull() & col("sectionid").isNotNull() & col("dateenrolled").isNotNull()) \
        .select(F.abs("sectionid").alias("_abs_sec"), "studentid", "dateenrolled", "dateleft")
    st = t.students.where(col("student_number").isNotNull()).select(col("id").alias("_sid"), "student_number")
    skm = number_map(t)
    j = (c.join(act, col("_abs_sec") == col("_secid"))
         .join(st, col("studentid") == col("_sid"))
         .join(dimension(skm), col("_secsch") == col("school_key"), "left")
         .join(dimension(cal), (col("_cal_sch") == col("_secsch")) & (col("dateenrolled") <= col("_cl"))
               & (F.coalesce(col("dateleft"), col("_cl")) >= col("_cf"))))
    x = j.select(
        clip(col("section_number").cast("string"), 20).alias("sectionNum"),
        clip(col("student_number").cast("string"), 20).alias("studentNum"),
        clip("course_number", 30).alias("courseNum"),
        clip(col("schoolNum").cast("string"), 10).alias("schoolNum"),
        clip("calendarName", 30).alias("calendarName"),
        col("dateenrolled").alias("startDate"), col("dateleft").alias("endDate"),
        F.lit(None).cast("int").alias("exclude"))
    rules = [("ERR_REQUIRED_sectionNumber", col("sectionNum").isNull()),
             ("ERR_REQUIRED_studentNumber", col("studentNum").isNull()),
             required("startDate"), required("calendarName")]
    return finalize(x, ["sectionNum", "studentNum", "courseNum", "schoolNum", "calendarName", "startDate",
                        "endDate", "exclude"], rules)


@extract("courseRequest", batch=2, key=("studentNumber", "courseNumber", "schoolNum"),
         refs=(("studentNumber", "student", "studentNum"), ("courseNumber", "course", "courseNum"),
               ("schoolNum", "school", "schoolNum")), school="schoolNum")
def course_request(t: Tables, p: ExtractParams) -> DataFrame:
    y = active_year_containing(t.terms, p.as_of_date).scalar()
    skm = number_map(t).where(col("schoolNum").isNotNull())
    cal = _active_yearrec_calendars(t, y).select(
        col("schoolNum").alias("_cs"), calendar_name_span("firstday", "lastday", "schoolName").alias("calendarName"))
    ty = t.terms.where(col("yearid") == y).select(col("id").alias("_tid"), col("schoolid").alias("_tsch"))
    act = of_school(t, p, t.sections, "schoolid").join(
        dimension(ty), (col("termid") == col("_tid")) & (col("schoolid") == col("_tsch")),
        "left_semi").select(col("id").alias("_secid"), "course_number", col("schoolid").alias("_secsch"))
    st = t.students.where(col("student_number").isNotNull()).select(col("id").alias("_sid"), "student_number")
    j = (t.cc.select("sectionid", "studentid")
         .join(act, col("sectionid") == col("_secid"))
         .join(st, col("studentid") == col("_sid"))
         .join(dimension(skm), col("_secsch") == col("school_key"))
         .join(dimension(cal), col("_cs") == col("schoolNum")))
    src = j.select(F.substring(col("student_number").cast("string"), 1, 20).alias("s"),
                   F.substring(F.trim("course_number"), 1, 20).alias("c"),
                   F.substring(col("schoolNum").cast("string"), 1, 7).alias("n"), "calendarName").distinct()
    x = src.select(clip("s", 20).alias("studentNumber"), clip("c", 20).alias("courseNumber"),
                   clip("n", 7).alias("schoolNum"), clip("calendarName", 30).alias("calendarName"),
                   F.lit(None).cast("int").alias("exclude"))
    rules = [required(c, blank=True) for c in ("studentNumber", "courseNumber", "schoolNum", "calendarName")]
    return finalize(x, ["studentNumber", "courseNumber", "schoolNum", "calendarName", "exclude"], rules)
