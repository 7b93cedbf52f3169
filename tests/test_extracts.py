"""Extract-level checks: registry, placeholders, rendering, runner, properties."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from rollbook.params import ExtractParams
from rollbook.plans.programs import PLACEHOLDER_SPECS, placeholder_program
from rollbook.plans.registry import all_extracts


def test_registry_covers_catalogue():
    names = set(all_extracts())
    # 73 scripts (standards spooled twice counts once) + the documented roster extract
    assert len(names) == 74
    for n in ("enrollment", "student", "contact", "roster", "transcript", "fee", "CTE", "gifted", "locker",
              "2627Enrollment", "student_roster_extract", "visionScreening", "period", "specialEducationSummary"):
        assert n in names


def test_placeholders_yield_exactly_one_marker(tables):
    for name, (cols, _req, marker) in PLACEHOLDER_SPECS.items():
        rows = placeholder_program(tables, name).collect()
        assert len(rows) == 1, name
        assert rows[0]["row_type"] == "ERROR"
        assert rows[0]["validation_errors"] == marker["validation_errors"]
        assert [c for c, _ in cols] == rows[0].__fields__[1:-1]


def test_placeholder_accepts_real_source(spark, tables):
    def src(t, p):
        return t.students.select(F.col("student_number").cast("string").alias("studentNum"),
                                 F.col("entrydate").alias("startDate"))
    out = placeholder_program(tables, "gifted", source=src)
    assert out.count() == tables.students.count()
    assert out.where("row_type = 'ERROR'").count() == tables.students.where("entrydate is null").count()


def test_clean_iff_no_errors(tables):
    ex = all_extracts()
    for name in ("enrollment", "student", "fee", "transcript", "userAccount"):
        df = ex[name](tables, ExtractParams())
        tcol = df.columns[0]
        bad = df.where(((F.col(tcol) == "CLEAN") & F.col("validation_errors").isNotNull())
                       | ((F.col(tcol) == "ERROR") & F.col("validation_errors").isNull()))
        assert bad.count() == 0, name


def test_dedup_keys_unique(tables):
    ex = all_extracts()
    cases = {"enrollment": ["studentNum", "startDate", "gradeLevel", "schoolNum", "calendarName"],
             "employee": ["employNum"], "userAccount": ["userName"],
             "healthCondition": ["studentNum", "code", "startDate"],
             "transcript": ["studentNum", "courseNum", "endYear", "actualTerm", "additionalKey"]}
    for name, keys in cases.items():
        df = ex[name](tables, ExtractParams())
        assert df.groupBy(*keys).count().where("count > 1").count() == 0, name


def test_every_table_extract_is_never_empty(tables):
    """'Never silently empty': every extract with a fallback policy has >= 1 row."""
    ex = all_extracts()
    for name in ("CTE", "fee", "courseFee", "homeless", "dentalScreening", "developmentalScreening", "gradingTask",
                 "healthCondition", "behaviorRole", "employment"):
        assert ex[name](tables, ExtractParams()).limit(1).count() == 1, name


def test_result_independent_of_shuffle_partitions(spark, tables):
    ex = all_extracts()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(map(tuple, ex["enrollment"](tables, ExtractParams()).collect()), key=str)
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = sorted(map(tuple, ex["enrollment"](tables, ExtractParams()).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


def test_render_quotes_and_flattens(spark):
    from rollbook.operators.render import header_line, render_lines
    df = spark.createDataFrame([('say "hi",\r\nbye', 5, None)], "t string, n int, d date")
    assert render_lines(df).collect()[0].line == '"say ""hi"",  bye","5",""'
    assert render_lines(df, policy="text").collect()[0].line == '"say ""hi"",  bye",5,""'
    assert header_line(["a", "b"]) == '"a","b"'
    assert header_line(["a", "b"], "text") == "a,b"


def test_runner_writes_header_first_and_logs(spark, tables):
    from rollbook.plans.runner import run_batches
    out = tempfile.mkdtemp(prefix="rollbook-run-")
    log = run_batches(spark, tables, out, names={"school", "fee", "locker", "gradingTask"}, quality=True,
                      parallelism=2)
    recs = {r.extract: r for r in log.collect()}
    assert set(recs) == {"school", "fee", "locker", "gradingTask"}
    assert all(r.status == "OK" for r in recs.values())
    assert recs["locker"].rows == 1 and recs["locker"].error_rows == 1
    parts = sorted(glob.glob(os.path.join(out, "batch1", "school", "part-*")))
    lines = [ln for p in parts for ln in open(p, encoding="utf-8").read().splitlines()]
    assert lines[0].startswith('"row_type","schoolNum"')
    assert len(lines) == recs["school"].rows + 1
    fee_parts = sorted(glob.glob(os.path.join(out, "batch4", "fee", "part-*")))  # unordered: no sort
    fee_lines = [ln for p in fee_parts for ln in open(p, encoding="utf-8").read().splitlines()]
    assert fee_lines[0] == '"row_type","studentNum","feeName","feeType","amount","validation_errors"'
    assert len(fee_lines) == recs["fee"].rows + 1
    task_parts = sorted(glob.glob(os.path.join(out, "batch3", "gradingTask", "part-*")))
    first = [ln for p in task_parts for ln in open(p, encoding="utf-8").read().splitlines()][0]
    assert first == "row_type,taskName,taskCode,taskSeq,postToTranscript,sourceStoreCode,validation_errors"


def test_rendered_csv_parses_back(spark, tables):
    """Property: the written file parses (csv module) back to the typed rows."""
    import csv

    from rollbook.plans.runner import run_batches
    out = tempfile.mkdtemp(prefix="rollbook-csv-")
    run_batches(spark, tables, out, names={"contact", "transcript"})
    ex = all_extracts()
    for name, batch in (("contact", 2), ("transcript", 3)):
        parts = sorted(glob.glob(os.path.join(out, f"batch{batch}", name, "part-*")))
        text = "".join(open(p, encoding="utf-8").read() for p in parts)
        rows = list(csv.reader(text.splitlines()))
        df = ex[name](tables, ExtractParams())
        assert rows[0] == df.columns
        assert len(rows) - 1 == df.count()
        def text(f):  # decimals without zeros at either end, as the files have them
            c = F.col(f.name).cast("string")
            if not f.dataType.simpleString().startswith("decimal"):
                return c
            c = F.when(c.contains("."), F.rtrim(F.rtrim(c, F.lit("0")), F.lit("."))).otherwise(c)
            return F.when(c.startswith("0."), F.substring(c, 2, 40)).when(c.startswith("-0."), F.concat(F.lit("-"), F.substring(c, 3, 40))).otherwise(c)

        want = sorted(tuple("" if v is None else str(v) for v in r) for r in df.select([text(f) for f in df.schema.fields]).collect())
        got = sorted(tuple(r) for r in rows[1:])
        if name == "contact":  # all fields quoted, dates as MM/dd/yyyy
            dates = [i for i, f in enumerate(df.schema.fields) if f.dataType.simpleString() == "date"]
            got = sorted(tuple(v if i not in dates or not v else
                               f"{v[6:10]}-{v[0:2]}-{v[3:5]}" for i, v in enumerate(r)) for r in got)
        assert got == want, name


def test_job_cli_runs(spark, tables, tmp_path):
    """The spark-submit entry point over a folder of SIS parquet tables."""
    from rollbook import job
    root = tmp_path / "sis"
    for n in job.SIS_TABLES:
        tables[n].write.parquet(str(root / n))
    rc = job.main(["--tables", str(root), "--out", str(tmp_path / "out"), "--as-of", "1998-10-15",
                   "--end-year", "1999", "--only", "school,roster", "--parallelism", "2"])
    assert rc == 0
    assert glob.glob(str(tmp_path / "out" / "batch2" / "roster" / "part-*"))


def test_derived_windows():
    """The windows of school year 2027 are those that the scripts hard-code for it."""
    import datetime as dt
    p = ExtractParams.for_run(dt.date(2026, 8, 15), 2027)
    assert (p.behavior_start, p.behavior_end) == (dt.date(2019, 7, 1), dt.date(2027, 6, 30))
    assert (p.window_start, p.window_end) == (dt.date(2025, 7, 1), dt.date(2027, 7, 1))
    assert (p.year_window_start, p.year_window_end) == (dt.date(2026, 7, 1), dt.date(2027, 7, 1))
    assert p.transcript_end_year == 2027
    assert ExtractParams.for_run(dt.date(2026, 8, 15), 2027, behavior_start=dt.date(2026, 7, 1)).behavior_start == dt.date(2026, 7, 1)


def test_incidents_of_the_whole_window(spark, tables):
    """Every dated log row and incident of the scripts' eight school years is written, by default
    and in a run; another window must be asked for."""
    import datetime as dt
    from pyspark.sql import functions as F
    days = [dt.date(2019, 6, 30), dt.date(2019, 7, 1), dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 25),
            dt.date(2024, 1, 31), dt.date(2027, 6, 30), dt.date(2027, 7, 1), None]
    rows = [(i, 1001, d, dt.datetime(d.year, d.month, d.day, 23, 59, 59) if d else None) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "id long, school long, d date, ts timestamp_ntz")

    def like(name, **known):
        return df.select(*[(known[f.name] if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in tables[name].schema.fields])

    swapped = tables.with_tables(
        log=like("log", id=F.col("id"), schoolid=F.col("school"), entry_date=F.col("d")),
        incident=like("incident", incident_id=F.col("id") + 100, school_number=F.col("school"), incident_ts=F.col("ts")))

    def ids(p):
        return sorted(int(r.incidentID) for r in all_extracts()["behaviorIncident"](swapped, p).collect())

    whole = [1, 2, 3, 4, 5, 6]
    assert ids(ExtractParams()) == whole + [100 + i for i in whole]
    run = ExtractParams.for_run(dt.date(2026, 8, 15), 2027)
    assert ids(run) == ids(ExtractParams())
    short = ExtractParams.for_run(dt.date(2026, 8, 15), 2027, behavior_start=dt.date(2024, 1, 2), behavior_end=dt.date(2024, 1, 25))
    assert ids(short) == [3, 4, 103, 104]


def test_job_on_shifted_data(spark, tables, tmp_path):
    """Data moved to 2026 give a job run without window options the rows that the fixture's windows give (all its
    behaviour days: the job's own window has eight school years)."""
    import datetime as dt
    from pyspark.sql import functions as F
    from rollbook import job
    behaviour = {"log", "incident", "incident_action"}  # from 2024; all else is from the 1990s
    root = tmp_path / "sis"
    for n in job.SIS_TABLES:
        df = tables[n]
        for f in df.schema.fields:
            c, kind = F.col(f.name), f.dataType.typeName()
            if kind in ("date", "timestamp", "timestamp_ntz"):
                years = F.make_ym_interval(F.lit(2 if n in behaviour else 28))
                df = df.withColumn(f.name, (c + years).cast(f.dataType))
            elif f.name == "yearid" or (n == "terms" and f.name == "id") or f.name == "termid":
                df = df.withColumn(f.name, (c + F.when(c < 0, -1).otherwise(1) * (28 if f.name == "yearid" else 2800)).cast(f.dataType))
        df.write.parquet(str(root / n))
    names = ("roster", "transcript", "behaviorIncident", "behaviorResolution")
    assert job.main(["--tables", str(root), "--out", str(tmp_path / "out"), "--as-of", "2026-10-15",
                     "--end-year", "2027", "--only", ",".join(names)]) == 0

    def rows(name):
        return sum(len(open(f).read().splitlines()) - 1 for f in glob.glob(str(tmp_path / "out" / "batch*" / name / "part-*")))

    own = ExtractParams(behavior_start=dt.date(2024, 1, 1), behavior_end=dt.date(2024, 1, 31))
    for n in ("roster", "transcript", "behaviorIncident"):
        assert rows(n) == all_extracts()[n](tables, own).count() > 0, n
    out = "".join(open(f).read() for f in glob.glob(str(tmp_path / "out" / "batch*" / "behaviorResolution" / "part-*")))
    assert rows("behaviorResolution") == tables.incident_action.count() and "ERR_OUTSIDE_7YR_WINDOW" not in out


def test_plans_have_no_keyless_joins_or_python(spark):
    """Every query of the extracts plans without cartesian products, nested-loop
    joins or Python evaluation: all joins are keyed, all expressions JVM-side."""
    import __spark_entry__ as E
    corpus = {k for m in E._corpus() for k in m.QUERIES}
    bad = {}
    for name, fn in E.queries().items():
        if name in corpus:
            continue
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        hits = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                            "FlatMapGroupsInPandas", "MapInPandas") if w in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_shared_scope_gives_same_results(spark, tables):
    """Run-level sharing of the scoped enrolment keys changes no result."""
    shared = tables.with_sharing()
    ex = all_extracts()
    try:
        for name in ("CTE", "homeless", "earlyLearning", "attendanceAggregate", "freeReducedEligibility"):
            a = sorted(map(repr, ex[name](tables, ExtractParams()).collect()))
            b = sorted(map(repr, ex[name](shared, ExtractParams()).collect()))
            assert a == b, name
        assert len(shared._memo) >= 2  # 7-year keys, 7-year keys with dates/courses, 2-year keys
    finally:
        shared.release_shared()
