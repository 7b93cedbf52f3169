"""Hand-made fixture cases (FIXTURES §2) run through the real extracts by
swapping single tables of the small catalog."""

import datetime as d

from pyspark.sql import functions as F

from rollbook.params import ExtractParams
from rollbook.plans.registry import all_extracts

EX = all_extracts()
P = ExtractParams()


def test_info_row_when_role_source_empty(spark, tables):
    empty = spark.createDataFrame([], "person_desc string")
    rows = EX["behaviorRole"](tables.with_tables(incident_person_role=empty), P).collect()
    assert [(r.row_type, r.roleName, r.validation_errors) for r in rows] == [
        ("INFO", None, "NO_SOURCE_ROWS_IN_PS.INCIDENT_PERSON_ROLE")]


def test_grade_levels_of_history_without_students(spark, tables):
    moved = tables.reenrollments.withColumn("studentid", -F.col("studentid"))
    want = set(EX["gradeLevel"](tables, P).collect())
    assert want and set(EX["gradeLevel"](tables.with_tables(reenrollments=moved), P).collect()) == want


def test_info_row_with_count_when_actions_empty(spark, tables):
    empty = tables.incident_action.limit(0)
    rows = EX["behaviorResolutionType"](tables.with_tables(incident_action=empty), P).collect()
    assert [(r.row_type, r.validation_errors) for r in rows] == [
        ("INFO", "NO_SOURCE_ROWS_IN_PS.INCIDENT_ACTION (COUNT=0)")]


def test_general_department_when_no_department(spark, tables):
    courses = tables.courses.withColumn("sched_department", F.lit("   "))
    out = EX["department"](tables.with_tables(courses=courses), P)
    names = {r.departmentName for r in out.collect()}
    assert names == {"General"}
    assert out.count() == tables.schools.where("school_number is not null").count()


def test_unknown_room_cut_to_20(spark, tables):
    secs = tables.sections.withColumn("room", F.lit(None).cast("string"))
    ss = tables.schedulesections.limit(0)
    out = EX["room"](tables.with_tables(sections=secs, schedulesections=ss), P).collect()
    assert {r.roomNumber for r in out} == {"UNKNOWN_FIX_IN_POWER"}


def test_summer_and_colliding_calendar_names(spark):
    from rollbook.plans.schools import summer_aware_name
    from rollbook.operators.relational import count_in_group
    rows = [(1001, "Lincoln Elementary School North", d.date(2025, 8, 20), d.date(2026, 5, 31)),
            (1002, "Lincoln Elementary School South", d.date(2025, 8, 20), d.date(2026, 5, 31)),
            (1003, "Camp", d.date(2025, 7, 6), d.date(2026, 5, 31))]
    df = spark.createDataFrame(rows, "schoolNum int, schoolName string, f date, l date")
    b = df.select("schoolNum", summer_aware_name(F.col("f"), F.col("l"), F.col("schoolName")).alias("base"))
    b = b.withColumn("ct", count_in_group(["base"]))
    names = {r.schoolNum: (r.base, r.ct) for r in b.collect()}
    # first 23 characters agree -> same base name, counted twice
    assert names[1001] == ("25-26 Lincoln Elementary Scho", 2) and names[1002][1] == 2
    assert names[1003] == ("25-26 Summer School", 1)


def test_roster_keeps_dropped_and_reenrolled(spark, tables):
    """A dropped enrolment (negative section id) and the re-enrolment are two rows."""
    sec = tables.sections.join(tables.terms.where("isyearrec = 1 and firstday >= date'1998-07-01' "
                                                  "and firstday < date'1999-07-01'")
                               .select(F.col("id").alias("_t"), F.col("schoolid").alias("_s")),
                               (F.col("termid") == F.col("_t")) & (F.col("schoolid") == F.col("_s")), "left_semi") \
        .limit(1).collect()[0]
    st = tables.students.where("student_number is not null").limit(1).collect()[0]
    cc = spark.createDataFrame([(-sec.id, st.id, "Cx", 900, d.date(1998, 9, 1), d.date(1998, 9, 15)),
                                (sec.id, st.id, "Cx", 900, d.date(1998, 10, 1), None)],
                               "sectionid long, studentid long, course_number string, termid int, "
                               "dateenrolled date, dateleft date")
    out = EX["roster"](tables.with_tables(cc=cc), P).collect()
    assert len(out) == 2
    assert sorted(r.startDate for r in out) == [d.date(1998, 9, 1), d.date(1998, 10, 1)]


def test_enrolment_spanning_two_years(spark, tables):
    """An open-ended enrolment overlaps every later year record of its school: one row per year."""
    st = tables.students.where("student_number is not null and entrydate is not null").limit(1) \
        .withColumn("entrydate", F.lit(d.date(1998, 1, 5))).withColumn("exitdate", F.lit(None).cast("date")) \
        .withColumn("schoolid", F.lit(1001))
    re = tables.reenrollments.limit(0)
    out = EX["enrollment"](tables.with_tables(students=st, reenrollments=re), P).collect()
    cal_years = tables.terms.where("isyearrec = 1 and schoolid = 1001 and lastday >= date'1998-01-05'").count()
    assert len(out) == cal_years >= 2
    assert len({r.calendarName for r in out}) == len(out)


def test_history_wins_over_current(spark, tables):
    st = tables.students.where("student_number is not null").limit(1) \
        .withColumn("entrydate", F.lit(d.date(1998, 9, 1))).withColumn("exitdate", F.lit(d.date(1999, 3, 1))) \
        .withColumn("schoolid", F.lit(1001)).withColumn("grade_level", F.lit(5))
    sid = st.collect()[0].id
    re = spark.createDataFrame([(sid, d.date(1998, 9, 1), d.date(1999, 1, 1), 5, 1001, "H", "W9")],
                               "studentid long, entrydate date, exitdate date, grade_level int, schoolid int, "
                               "entrycode string, exitcode string")
    out = EX["enrollment"](tables.with_tables(students=st, reenrollments=re), P).collect()
    assert [r.sourceTable for r in out] == ["REENROLLMENTS"]
    assert out[0].gradeLevel == "05"


def test_fee_zero_balance_dropped(spark, tables):
    ft = tables.fee_transaction
    one = ft.limit(1).collect()[0]
    rows = [(one.feeid, one.studentid, v) for v in ("10.00", "-10.00")]
    df = spark.createDataFrame(rows, "feeid long, studentid long, neteffect string") \
        .withColumn("neteffect", F.col("neteffect").cast("decimal(12,2)"))
    out = EX["fee"](tables.with_tables(fee_transaction=df), P).collect()
    # the only student nets to zero -> no fee rows -> the marker row
    assert [(r.row_type, r.validation_errors) for r in out] == [("ERROR", "ERR_NO_SOURCE_ROWS_FOR_FEE; ")]
