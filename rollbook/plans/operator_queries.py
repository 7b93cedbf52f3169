"""Operator-level queries: one small plan per library operator, straight over
the driver tables / derived views, each with a DuckDB twin in ``oracle``."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame

from rollbook.sources.catalog import Tables

OPERATOR_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def op(name: str):
    def deco(fn):
        OPERATOR_QUERIES[name] = fn
        return fn
    return deco


# ---- operator queries ---------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from rollbook.functions.text import col  # noqa: E402
from rollbook.operators import quality as Q  # noqa: E402
from rollbook.operators import relational as R  # noqa: E402
from rollbook.operators import years as Y  # noqa: E402
from rollbook.params import ExtractParams  # noqa: E402

P = ExtractParams()
# the school of the queries that ask for one, by its dcid
SCHOOL_DCID = 507


def _extract(name, t):
    from rollbook.plans.registry import all_extracts
    return all_extracts()[name](t, P)


@op("active_students_asof")
def active_students_asof(t):
    """C01 + P06: students enrolled on the as-of date, sentinel numbers dropped."""
    s = R.drop_sentinels(t.students, "student_number", bad=(0,))
    return R.active_as_of(s, "entrydate", "exitdate", P.as_of_date).select(
        "id", "student_number", "schoolid", "entrydate", "exitdate")


@op("school_key_map")
def school_key_map_q(t):
    """Every identifier of a school mapped to its number and name."""
    return R.school_key_map(t.schools)


@op("student_scope_7y")
def student_scope_7y(t):
    """C07 + C04c: distinct students with an enrolment in the last seven school years."""
    from rollbook.plans.programs import student_keys_in_scope
    return student_keys_in_scope(t, P, 6).select(col("_key").alias("studentid"), "studentNum")


@op("requested_or_latest_year")
def requested_or_latest_year_q(t):
    """Requested yearid if present in cc, else the newest."""
    return Y.requested_or_latest_year(t.cc, P.requested_yearid)


@op("active_year_containing")
def active_year_containing_q(t):
    """Best year record (contains as-of, latest end, largest id)."""
    return Y.active_year_containing(t.terms, P.as_of_date)


@op("active_or_upcoming_years")
def active_or_upcoming_years_q(t):
    """C04d/P16: current year, future summers, next fall start."""
    from rollbook.plans.schools import active_or_upcoming_years
    return active_or_upcoming_years(t.terms, P.as_of_date)


@op("calendar_name_unique")
def calendar_name_unique(t):
    """C05c + C05d + W07 over every year record: summer names, collision suffix."""
    from rollbook.plans.schools import summer_aware_name
    skm = R.school_key_map(t.schools, keys=("school_number",))
    yr = t.terms.where(col("isyearrec") == 1).join(R.dimension(skm), col("schoolid") == col("school_key")) \
        .where(col("schoolNum") != 999999)
    base = yr.select("schoolNum", "yearid", summer_aware_name(col("firstday"), col("lastday"), col("schoolName"))
                     .alias("base"))
    named = base.withColumn("name_ct", R.count_in_group(["yearid", "base"]))
    sn = col("schoolNum").cast("string")
    return named.select(
        sn.alias("schoolNum"), "yearid", "name_ct",
        F.when(col("name_ct") == 1, F.substring("base", 1, 30))
         .otherwise(F.concat(F.expr("substring(base, 1, 30 - (1 + length(cast(schoolNum as string))))"),
                             F.lit("-"), sn)).alias("calendarName"))


@op("calendar_schedule_pairs")
def calendar_schedule_pairs_q(t):
    """Distinct in-session (school, cycle day, bell schedule) within a year record."""
    from rollbook.plans.schools import _schedule_pairs, _window_yearrecs
    return _schedule_pairs(t, _window_yearrecs(t, P)).select(
        col("_ps").alias("schoolid"), col("_pcd").alias("cycle_day_id"), col("_pbs").alias("bell_schedule_id"))


@op("listagg_parts_by_order")
def listagg_parts_by_order(t):
    """Parts of each order joined by '; ' in line order (keys repeat, so the
    order includes every column that can differ)."""
    li = t.lineitem
    folded = R.listagg_ordered(li, ["l_orderkey"], F.concat(F.lit("P"), col("l_partkey").cast("string")),
                               [col("l_linenumber"), col("l_partkey"), col("l_suppkey")], alias="parts")
    return folded.select("l_orderkey", "parts")


@op("pivot_by_priority")
def pivot_by_priority(t):
    """Newest order key per customer for each priority class."""
    o = t.orders
    return R.pivot_conditional_max(o, ["o_custkey"], {
        "urgent": (col("o_orderpriority") == "1-URGENT", col("o_orderkey")),
        "high": (col("o_orderpriority") == "2-HIGH", col("o_orderkey")),
        "other": (~col("o_orderpriority").isin("1-URGENT", "2-HIGH"), col("o_orderkey")),
    })


@op("dedup_lineitem_latest")
def dedup_lineitem_latest(t):
    """W01 on a key that is not unique in the data ((orderkey, linenumber)):
    latest ship date wins, every other column breaks ties."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag",
                           "l_linestatus")
    return R.dedup_first(li, ["l_orderkey", "l_linenumber"], [
        col("l_shipdate").desc(), col("l_partkey").asc(), col("l_suppkey").asc(), col("l_returnflag").asc(),
        col("l_linestatus").asc()])


@op("fee_balance")
def fee_balance(t):
    """Decimal net balance per (student, fee type), zero dropped."""
    ft = t.fee_transaction
    f = t.fee.select(col("id").alias("_fid"), "fee_type_id")
    return R.net_balance(ft.join(f, col("feeid") == col("_fid")), ["studentid", "fee_type_id"], "neteffect")


@op("quality_summary_enrollment")
def quality_summary_enrollment(t):
    """Row types and error codes of the enrollment extract."""
    return Q.quality_summary(_extract("enrollment", t), "enrollment")


@op("check_unique_roster")
def check_unique_roster(t):
    """(section, student, start) keys that repeat in the roster (re-enrolments)."""
    return Q.check_unique(_extract("roster", t), ["sectionNum", "studentNum", "startDate"])


@op("check_reference_roster_section")
def check_reference_roster_section(t):
    """Roster (section, school) pairs with no row in the section extract."""
    return Q.check_reference(_extract("roster", t), _extract("section", t), ["sectionNum", "schoolNum"])


@op("check_reference_enrollment_calendar")
def check_reference_enrollment_calendar(t):
    """Enrolment calendars missing from the calendar extract (names are built
    differently in the two files, SURVEY 8.9)."""
    return Q.check_reference(_extract("enrollment", t), _extract("calendar", t), ["schoolNum", "calendarName"])


@op("render_enrollment_lines")
def render_enrollment_lines(t):
    """The enrollment file's data lines (quote-all policy, ISO dates)."""
    from rollbook.operators.render import render_lines
    from rollbook.plans.registry import all_extracts
    spec = all_extracts()["enrollment"]
    return render_lines(_extract("enrollment", t), spec.date_format, spec.ts_format, spec.quote)


def _numbered(name, t):
    from rollbook.plans.registry import all_extracts
    from rollbook.plans.runner import numbered_lines
    spec = all_extracts()[name]
    return numbered_lines(spec(t, P), spec)


@op("lines_student")
def lines_student(t):
    """The student file, header first, every line with its place in it."""
    return _numbered("student", t)


@op("lines_school")
def lines_school(t):
    """The school file in the order of the number inside the school number."""
    return _numbered("school", t)


@op("lines_transcript")
def lines_transcript(t):
    """The transcript file: five sort keys, quotes field by field, unquoted header."""
    return _numbered("transcript", t)


@op("lines_grading_task")
def lines_grading_task(t):
    """The grading task file, whose empty codes have no quotes."""
    return _numbered("gradingTask", t)


@op("lines_standards")
def lines_standards(t):
    """The standards file: all fields in quotes but the first, text as stored."""
    return _numbered("standards", t)


@op("integrity_findings")
def integrity_findings(t):
    """All documented unique keys and references of the files, in one keyed pass."""
    from rollbook.operators.integrity import Reference, declared, findings
    from rollbook.plans.registry import all_extracts
    ex = all_extracts()
    checks = declared(s for s in ex.values() if s.reads_tables)
    names = sorted({c.child if isinstance(c, Reference) else c.file for c in checks} | {c.parent for c in checks if isinstance(c, Reference)})
    return findings({n: ex[n](t, P) for n in names}, checks)


@op("school_filter_roster")
def school_filter_roster(t):
    """The roster of one school, named by its dcid; the school's identifiers reach the scan of the sections."""
    import dataclasses
    from rollbook.plans.registry import all_extracts
    return all_extracts()["roster"](t, dataclasses.replace(P, school_id=SCHOOL_DCID))


@op("school_filter_enrollment")
def school_filter_enrollment(t):
    """The enrolments of one school, current and history."""
    import dataclasses
    from rollbook.plans.registry import all_extracts
    return all_extracts()["enrollment"](t, dataclasses.replace(P, school_id=SCHOOL_DCID))
