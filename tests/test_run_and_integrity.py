"""Fallbacks decided by the write, the run as a commit, the run's quality summary, integrity
across files, the school filter and the joins that do not rest on a broadcast."""

import collections
import dataclasses
import datetime as dt
import glob
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from rollbook.operators import quality as Q
from rollbook.operators import relational as R
from rollbook.operators.integrity import Reference, UniqueKey, findings
from rollbook.operators.render import render_lines
from rollbook.params import ExtractParams
from rollbook.plans import people, registry, runner
from rollbook.plans.registry import all_extracts

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
P = ExtractParams()


def lines(folder):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(os.path.join(str(folder), "part-*")))).splitlines()


def rows_of(df):
    return collections.Counter(map(repr, map(tuple, df.collect())))


# ---- fallback policies -------------------------------------------------------------------

def test_marker_when_no_rows(spark, tables, tmp_path):
    spec = all_extracts()["homeless"]
    none = tables.with_tables(s_nd_stu_homelessprograms_c=tables.s_nd_stu_homelessprograms_c.limit(0))
    for t, n in ((tables, None), (none, 1)):
        counts = runner.write_extract(spec.rows(t, P), spec, str(tmp_path / str(n)))
        got = lines(tmp_path / str(n))
        assert len(got) - 1 == counts["rows"] == (n or spec(t, P).count())
    assert got[1] == '"ERROR","","","ERR_NO_SOURCE_ROWS_FOR_HOMELESS; "' and counts["error_rows"] == 1


def test_marker_when_source_is_empty(tables):
    spec = all_extracts()["behaviorRole"]
    assert spec(tables, P).where("row_type = 'INFO'").count() == 0
    none = spec(tables.with_tables(incident_person_role=tables.incident_person_role.limit(0)), P).collect()
    assert [(r.row_type, r.validation_errors) for r in none] == [("INFO", "NO_SOURCE_ROWS_IN_PS.INCIDENT_PERSON_ROLE")]


def test_default_rows_when_no_departments(tables):
    spec = all_extracts()["department"]
    none = spec(tables.with_tables(courses=tables.courses.withColumn("sched_department", F.lit(" "))), P)
    assert {r.departmentName for r in none.collect()} == {"General"}
    assert none.count() == tables.schools.where("school_number is not null").count()
    assert spec(tables, P).where("departmentName = 'General'").count() == 0


EVENTS = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.dir", "file://{events}").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from rollbook.plans.registry import all_extracts
from rollbook.plans.runner import run_batches
from rollbook.sources.catalog import Tables
t = Tables.from_dir(spark, {tables!r}, {names!r})
run_batches(spark, t, {out!r}, names={extracts!r})
spark.stop()
"""


def test_facts_are_read_once(spark, tables, tmp_path):
    """By the event log: an extract with a marker reads each row of its fact table once, and the
    sections are read once for all extracts over their keys."""
    names = ["attendance", "students", "cc", "sections", "terms", "courses", "schools", "schedulesections", "fee", "orders"]
    facts = {"attendance": 1, "sections": 1, "schedulesections": 1, "fee": 1, "courses": 1}
    names = [n for n in names if n in tables]
    for n in names:
        tables[n].coalesce(1).write.parquet(str(tmp_path / "t" / n))
    os.mkdir(tmp_path / "events")
    script = EVENTS.format(root=ROOT, events=tmp_path / "events", tables=str(tmp_path / "t"), names=names, out=str(tmp_path / "out"),
                           extracts={"attendanceAggregate", "department", "room", "courseFee"})
    subprocess.run([sys.executable, "-c", script], check=True, timeout=400, capture_output=True)
    scans, values = {}, collections.Counter()

    def walk(node):
        where = node.get("metadata", {}).get("Location", "")
        table = where.rsplit("/", 1)[-1].rstrip("]") if "/t/" in where else None
        for m in node["metrics"]:
            if table and m["name"] == "number of output rows":
                scans[m["accumulatorId"]] = table
        for c in node["children"]:
            walk(c)

    for f in glob.glob(str(tmp_path / "events" / "*")):
        for line in open(f):
            e = json.loads(line)
            if "sparkPlanInfo" in e:
                walk(e["sparkPlanInfo"])
            for a in e.get("Task Info", {}).get("Accumulables", []) if e["Event"] == "SparkListenerTaskEnd" else []:
                values[a["ID"]] += int(a["Update"]) if str(a.get("Update", "")).isdigit() else 0
    read = collections.Counter()
    for i, table in scans.items():
        read[table] += values[i]
    for table, times in facts.items():
        n = tables[table].count()
        # not-null filters at the scan may leave a few rows out
        assert 0 < read[table] <= times * n, (table, read[table], n)


# ---- the run --------------------------------------------------------------------------------

SOME = {"school", "fee", "gradingTask", "enrollment", "behaviorRole", "concussionScreening", "2627Enrollment", "homeless", "contact",
        "student_roster_extract", "locker"}


def test_quality_summary_equals_a_recount(spark, tables, tmp_path):
    out = str(tmp_path / "out")
    log = runner.run_batches(spark, tables, out, names=SOME, quality=True, parallelism=3)
    assert {r.status for r in log.collect()} == {"OK"}
    got = {(r["extract"], r.kind, r.item): r.n for r in spark.read.json(f"{out}/_quality_summary").collect()}
    want = {}
    for name in SOME:
        df = all_extracts()[name](tables, P)
        kind = next((c for c in runner.TYPE_COLUMNS if c in df.columns), None)
        if kind is None:
            want[(name, "row_type", "(none)")] = df.count()
            continue
        for r in Q.quality_summary(df, name, type_col=kind).collect():
            code = r.item if r.kind == "row_type" or r.item in Q.codes_of(all_extracts_rows(name, tables)) else "(other)"
            want[(name, r.kind, code)] = want.get((name, r.kind, code), 0) + r.n
    assert got == want
    assert any(k == "error_code" for _, k, _ in got)


def all_extracts_rows(name, tables):
    out = all_extracts()[name].rows(tables, P)
    return out.rows if isinstance(out, Q.Rows) else out


def test_a_failed_write_leaves_the_old_files(spark, tables, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    runner.run_batches(spark, tables, out, names={"school", "room"})
    before = {n: lines(tmp_path / "out" / "batch1" / n) for n in ("school", "room")}
    real = runner._commit

    def lost(spark, staged, final):
        if final.endswith("/room"):
            raise KeyboardInterrupt  # the driver goes away between write and commit
        real(spark, staged, final)

    monkeypatch.setattr(runner, "_commit", lost)
    with pytest.raises(KeyboardInterrupt):
        runner.run_batches(spark, tables, out, names={"school", "room"}, resume="r2")
    assert {n: lines(tmp_path / "out" / "batch1" / n) for n in before} == before
    logged = [r["extract"] for r in runner.read_log(spark, out, "r2")]
    assert "room" not in logged
    monkeypatch.setattr(runner, "_commit", real)
    ran = []
    monkeypatch.setattr(runner, "write_extract", lambda o, s, p, f=runner.write_extract: (ran.append(s.name), f(o, s, p))[1])
    log = runner.run_batches(spark, tables, out, names={"school", "room"}, resume="r2").collect()
    assert ran == [n for n in ("room", "school") if n not in logged] and {r.status for r in log} == {"OK"} and len(log) == 2
    assert not os.path.exists(f"{out}/_staging/r2")


def test_a_failing_extract_is_logged_whole(spark, tables, tmp_path):
    bad = tables.with_tables(schools=tables.schools.drop("name"))
    log = runner.run_batches(spark, bad, str(tmp_path / "out"), names={"school", "behaviorRole"}).collect()
    by = {r["extract"]: r for r in log}
    assert by["behaviorRole"].status == "OK" and by["school"].status == "FAILED" and "name" in by["school"].message


# ---- order and quoting -----------------------------------------------------------------------

def test_numbered_lines_equal_the_written_file(spark, tables, tmp_path):
    for name in ("school", "student", "gradingTask"):
        spec = all_extracts()[name]
        df = spec(tables, P)
        runner.write_extract(spec.rows(tables, P), spec, str(tmp_path / name))
        want = [r.line for r in sorted(runner.numbered_lines(df, spec).collect(), key=lambda r: r.ordinal)]
        assert lines(tmp_path / name) == want, name


def test_field_policies(spark):
    df = spark.createDataFrame([('a "b"\r\nc', None, None, 0.5)], "a string, b string, c string, n double") \
        .withColumn("d", F.col("n").cast("decimal(6,2)")).withColumn("e", F.lit(-2).cast("decimal(6,2)")).drop("n")
    line = lambda **f: render_lines(df, policy="bare", fields=f).first().line
    assert line(a="text", b="text", c="optional") == '"a ""b""  c","",,.5,-2'
    assert line(a="stored") == '"a ""b""\r\nc",,,.5,-2'
    with pytest.raises(ValueError):
        render_lines(df, fields={"x": "text"})


# ---- integrity ------------------------------------------------------------------------------

def test_findings_on_a_small_graph(spark):
    parent = spark.createDataFrame([("1",), ("2",), (None,)], "s string")
    child = spark.createDataFrame([("a", 1), ("a", 1), ("b", 3), ("b", None), (None, None), (None, None), (None, 9)], "k string, s int")
    checks = [UniqueKey("child", ("k", "s")), UniqueKey("child", ("k",)), Reference("child", ("s",), "parent", ("s",))]
    got = {tuple(r) for r in findings({"child": child, "parent": parent}, checks).collect()}
    assert got == {("DUPLICATE_KEY", "child", "k,s", "a|1", 2), ("DUPLICATE_KEY", "child", "k", "a", 2), ("DUPLICATE_KEY", "child", "k", "b", 2),
                   ("MISSING_PARENT", "child", "s -> parent", "3", 1), ("MISSING_PARENT", "child", "s -> parent", "9", 1)}


# ---- school filter ----------------------------------------------------------------------------

def test_every_school_extract_filters_to_its_school(spark, tables):
    """A run for a school, by any of its identifiers, has the full run's rows of that school."""
    names = [s.name for s in all_extracts().values() if s.school]
    assert len(names) >= 18
    ex, filled = all_extracts(), 0
    most = ex["roster"](tables, P).groupBy("schoolNum").count().orderBy(F.desc("count"), "schoolNum").first().schoolNum
    ids = tables.schools.where(F.col("school_number").cast("string") == most).first()
    number = ids.school_number
    for name in names:
        full = ex[name](tables, P)
        c = ex[name].school
        for asked in (ids.id, ids.dcid, number) if name in ("section", "enrollment") else (ids.dcid,):
            mine = ex[name](tables, dataclasses.replace(P, school_id=asked))
            want = rows_of(full.where(F.col(c).cast("string") == str(number)))
            # a school without rows has the extract's marker, if it has one
            assert rows_of(mine if want else mine.where(F.col(c).isNotNull())) == want, name
        filled += bool(want)
    assert filled >= 12


def test_school_filter_reaches_the_scan(spark, tables, tmp_path):
    for n in ("sections", "students", "reenrollments", "terms", "schools", "schoolstaff", "users"):
        tables[n].write.parquet(str(tmp_path / n))
    t = tables.with_tables(**{n: spark.read.parquet(str(tmp_path / n)) for n in ("sections", "students", "reenrollments", "terms", "schools",
                                                                                   "schoolstaff", "users")})
    p = dataclasses.replace(P, school_id=508)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        for name, table in (("enrollment", "reenrollments"), ("section", "sections"), ("employment", "schoolstaff")):
            out = all_extracts()[name].rows(t, p)
            plan = (out.rows if isinstance(out, Q.Rows) else out)._jdf.queryExecution().executedPlan().toString()
            scans = [x for x in plan.splitlines() if "FileScan" in x and f"/{table}]" in x]
            assert scans and all("In(schoolid" in x for x in scans), (name, scans)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_unknown_school_gives_no_rows(tables):
    assert all_extracts()["enrollment"](tables, dataclasses.replace(P, school_id=-5)).count() == 0


# ---- joins -------------------------------------------------------------------------------------

def test_overlap_join_is_the_same_without_a_broadcast(spark):
    r = random.Random(4)
    day = lambda: dt.date(r.randint(1995, 2006), r.randint(1, 12), r.randint(1, 28)) if r.random() > 0.1 else None
    left = spark.createDataFrame([(i, r.choice("abc"), day(), day()) for i in range(400)] + [(-1, "a", dt.date(1000, 1, 1), dt.date(9999, 1, 1))],
                                 "i int, k string, ls date, le date")
    right = spark.createDataFrame([(i, r.choice("abcd"), day(), day()) for i in range(80)], "j int, k2 string, rs date, re date")
    args = (left, right, [("k", "k2")], "ls", "le", "rs", "re")
    small, large = R.overlap_join(*args), R.overlap_join(*args, broadcast_rows=10)
    assert rows_of(small) == rows_of(large) and small.count() > 500 and small.columns == large.columns
    assert "BroadcastNestedLoop" not in large._jdf.queryExecution().executedPlan().toString()


def test_contact_with_a_hot_person(spark, tables, monkeypatch):
    """A third of all links hang on one person: same rows, and the person's links meet it in many tasks."""
    sca = tables.studentcontactassoc
    hot = sca.select(F.min("personid")).first()[0]
    t = tables.with_tables(studentcontactassoc=sca.withColumn(
        "personid", F.when(F.col("studentcontactassocid") % 3 == 0, F.lit(hot)).otherwise(F.col("personid"))))
    plain = rows_of(all_extracts()["contact"](t, P))
    monkeypatch.setattr(people, "HOT_LINKS", 20)
    assert rows_of(all_extracts()["contact"](t, P)) == plain and sum(plain.values()) > 100
    links = t.studentcontactassoc.select("studentcontactassocid", "personid")
    spread = R.salted_join(links, tables.person.select(F.col("id").alias("_pid")), "personid", "_pid", ["studentcontactassocid"], hot_rows=20)
    parts = spread.where(F.col("personid") == hot).select(F.spark_partition_id().alias("p")).distinct().count() \
        if "SortMergeJoin" in spread._jdf.queryExecution().executedPlan().toString() else 2
    assert parts > 1
