"""Oracle SQL for the operator-level queries."""

from oracle import register
from rollbook.params import ExtractParams

P = ExtractParams()
AS_OF = f"DATE '{P.as_of_date.isoformat()}'"

register("active_students_asof", f"""
SELECT id, student_number, schoolid, entrydate, exitdate FROM students
WHERE student_number IS NOT NULL AND student_number <> 0 AND entrydate <= {AS_OF} AND (exitdate IS NULL OR exitdate >= {AS_OF})""")

register("school_key_map", """
SELECT DISTINCT school_key, schoolNum, schoolName FROM (
  SELECT CAST(id AS BIGINT) AS school_key, CAST(school_number AS BIGINT) AS schoolNum, name AS schoolName FROM schools
  UNION ALL SELECT CAST(dcid AS BIGINT), CAST(school_number AS BIGINT), name FROM schools
  UNION ALL SELECT CAST(school_number AS BIGINT), CAST(school_number AS BIGINT), name FROM schools)""")

AY = f"""ay AS (SELECT CASE WHEN EXISTS (SELECT 1 FROM cc WHERE termid IS NOT NULL AND floor(termid/100) = {P.requested_yearid})
  THEN {P.requested_yearid} ELSE (SELECT max(floor(termid/100)) FROM cc WHERE termid IS NOT NULL) END AS yearid)"""

register("student_scope_7y", "WITH " + AY + """
SELECT DISTINCT s.id AS studentid, s.student_number AS studentNum FROM students s JOIN cc ON cc.studentid = s.id CROSS JOIN ay
WHERE cc.termid IS NOT NULL AND floor(cc.termid/100) BETWEEN ay.yearid - 6 AND ay.yearid AND s.student_number IS NOT NULL""")

register("requested_or_latest_year", "WITH " + AY + " SELECT CAST(yearid AS INTEGER) AS yearid FROM ay")

register("active_year_containing", f"""
SELECT CAST(yearid AS INTEGER) AS yearid FROM terms WHERE isyearrec = 1
ORDER BY CASE WHEN {AS_OF} BETWEEN firstday AND lastday THEN 0 ELSE 1 END, lastday DESC NULLS LAST, id DESC NULLS LAST LIMIT 1""")

register("active_or_upcoming_years", f"""
SELECT DISTINCT t.yearid FROM terms t WHERE t.isyearrec = 1 AND (
  {AS_OF} BETWEEN t.firstday AND t.lastday
  OR (month(t.firstday) IN (6,7) AND t.firstday > {AS_OF})
  OR t.firstday = (SELECT min(t2.firstday) FROM terms t2 WHERE t2.isyearrec = 1 AND t2.firstday > {AS_OF} AND month(t2.firstday) >= 7))""")

register("calendar_name_unique", """WITH
b AS (
  SELECT CAST(s.school_number AS BIGINT) AS schoolNum, t.yearid,
         CASE WHEN month(t.firstday) IN (6,7)
              THEN right(CAST(year(t.firstday) AS VARCHAR),2) || '-' || right(CAST(year(t.lastday) AS VARCHAR),2) || ' Summer School'
              ELSE right(CAST(year(t.firstday) AS VARCHAR),2) || '-' || right(CAST(year(t.lastday) AS VARCHAR),2) || ' ' || substr(trim(s.name),1,23) END AS base
  FROM terms t JOIN schools s ON CAST(s.school_number AS BIGINT) = t.schoolid
  WHERE t.isyearrec = 1 AND s.school_number <> 999999
),
n AS (SELECT b.*, count(*) OVER (PARTITION BY yearid, base) AS name_ct FROM b)
SELECT CAST(schoolNum AS VARCHAR) AS schoolNum, yearid, name_ct,
       CASE WHEN name_ct = 1 THEN substr(base,1,30)
            ELSE substr(base,1,30-(1+length(CAST(schoolNum AS VARCHAR)))) || '-' || CAST(schoolNum AS VARCHAR) END AS calendarName
FROM n""")

WS, WE = f"DATE '{P.year_window_start.isoformat()}'", f"DATE '{P.year_window_end.isoformat()}'"
register("calendar_schedule_pairs", f"""WITH
yr AS (SELECT t.schoolid, t.firstday, t.lastday FROM terms t JOIN schools s ON CAST(s.school_number AS BIGINT) = t.schoolid
       WHERE t.isyearrec = 1 AND t.firstday >= {WS} AND t.firstday < {WE} AND s.school_number IS NOT NULL AND s.school_number <> 999999)
SELECT DISTINCT cd.schoolid, cd.cycle_day_id, cd.bell_schedule_id FROM calendar_day cd
JOIN yr ON yr.schoolid = cd.schoolid AND cd.date_value BETWEEN yr.firstday AND yr.lastday
WHERE cd.insession = 1 AND cd.cycle_day_id IS NOT NULL AND cd.bell_schedule_id IS NOT NULL""")

register("listagg_parts_by_order", """
SELECT l_orderkey, string_agg('P' || CAST(l_partkey AS VARCHAR), '; ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS parts
FROM lineitem GROUP BY l_orderkey""")

register("pivot_by_priority", """
SELECT o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS urgent,
       max(CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderkey END) AS high,
       max(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_orderkey END) AS other
FROM orders GROUP BY o_custkey""")

register("dedup_lineitem_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_returnflag, l_linestatus) rn
  FROM lineitem) WHERE rn = 1""")

register("fee_balance", """
SELECT * FROM (SELECT ft.studentid, f.fee_type_id, CAST(sum(ft.neteffect) AS DECIMAL(10,2)) AS amount
               FROM fee_transaction ft JOIN fee f ON f.id = ft.feeid GROUP BY ft.studentid, f.fee_type_id) WHERE amount <> 0""")


def _extract_cte(name: str) -> str:
    """The registered oracle text of an extract, usable as a subquery."""
    from oracle import SQL
    return SQL[name]


def _wrap(name: str, alias: str) -> str:
    return f"{alias} AS ({_extract_cte(name)})"


def _later():
    register("quality_summary_enrollment", "WITH " + _wrap("enrollment", "e") + """,
codes AS (SELECT trim(c) AS item FROM e, unnest(string_split(coalesce(validation_errors, ''), ';')) AS u(c))
SELECT 'enrollment' AS "extract", 'row_type' AS kind, row_type AS item, count(*) AS n FROM e GROUP BY row_type
UNION ALL
SELECT 'enrollment', 'error_code', item, count(*) FROM codes WHERE item <> '' GROUP BY item""")

    register("check_unique_roster", "WITH " + _wrap("roster", "r") + """
SELECT sectionNum, studentNum, startDate, count(*) AS n FROM r GROUP BY sectionNum, studentNum, startDate HAVING count(*) > 1""")

    register("check_reference_roster_section", "WITH " + _wrap("roster", "r") + ", " + _wrap("section", "s") + """
SELECT DISTINCT r.sectionNum, r.schoolNum FROM r
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.sectionNum IS NOT DISTINCT FROM r.sectionNum AND s.schoolNum IS NOT DISTINCT FROM r.schoolNum)""")

    register("check_reference_enrollment_calendar", "WITH " + _wrap("enrollment", "e") + ", " + _wrap("calendar", "c") + """
SELECT DISTINCT e.schoolNum, e.calendarName FROM e
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.schoolNum IS NOT DISTINCT FROM e.schoolNum AND c.calendarName IS NOT DISTINCT FROM e.calendarName)""")


def _render_later():
    from oracle.extracts_a import ENROLLMENT_COLS
    def q(c, date=False):
        v = f"strftime({c}, '%Y-%m-%d')" if date else f"CAST({c} AS VARCHAR)"
        return ("'\"' || replace(replace(replace(coalesce(" + v + ", ''), chr(13), ' '), chr(10), ' '), '\"', '\"\"') || '\"'")
    parts = " || ',' || ".join(q(c, c in ("startDate", "endDate")) for c in ENROLLMENT_COLS)
    register("render_enrollment_lines", "WITH " + _wrap("enrollment", "e") + f"\nSELECT {parts} AS line FROM e")


# ---- whole files: (ordinal, line) -------------------------------------------------

def _text(c: str, kind: str) -> str:
    if kind.startswith("%"):
        return f"strftime({c}, '{kind}')"
    if kind == "decimal":  # no zeros after the last decimal and none before the point
        v = f"CAST({c} AS VARCHAR)"
        v = f"CASE WHEN contains({v}, '.') THEN rtrim(rtrim({v}, '0'), '.') ELSE {v} END"
        return f"CASE WHEN starts_with({v}, '0.') THEN substr({v}, 2) WHEN starts_with({v}, '-0.') THEN '-' || substr({v}, 3) ELSE {v} END"
    return f"CAST({c} AS VARCHAR)"


def _quoted(v: str, flat: bool = True) -> str:
    v = f"coalesce({v}, '')"
    if flat:
        v = f"replace(replace({v}, chr(13), ' '), chr(10), ' ')"
    return "'\"' || replace(" + v + ", '\"', '\"\"') || '\"'"


def _file(key: str, extract: str, header: str, fields: list[tuple[str, str, str]], order: str) -> None:
    """``fields``: (column, how it is written, its kind)."""
    parts = []
    for c, how, kind in fields:
        v = _text(f'"{c}"', kind)
        parts.append({"q": _quoted(v), "stored": _quoted(v, flat=False), "bare": f"coalesce({v}, '')",
                      "optional": f"CASE WHEN {v} IS NULL THEN '' ELSE {_quoted(v)} END"}[how])
    line = " || ',' || ".join(f"({x})" for x in parts)
    register(key, "WITH " + _wrap(extract, "e") + f""",
l AS (SELECT e.*, {line} AS line FROM e)
SELECT CAST(row_number() OVER (ORDER BY {order}line) AS BIGINT) AS ordinal, line FROM l
UNION ALL SELECT CAST(0 AS BIGINT), '{header}'""")


def _files_later():
    all_quoted = lambda cols: ",".join(f'"{c}"' for c in cols)
    student = ("record_status studentNum emailAddress householdKey physicalAddress physicalCity physicalState physicalZip mailingAddress "
               "mailingCity mailingState mailingZip hispanicFlag lastName firstName middleName suffix legalLastName legalFirstName "
               "legalMiddleName legalGender birthDate gender raceCD homePhone validation_errors").split()
    _file("lines_student", "student", all_quoted(student),
          [(c, "q", "%m/%d/%Y" if c == "birthDate" else "") for c in student], "studentNum NULLS LAST, ")
    school = ("row_type schoolNum stateSchoolNum name phone address city state zip fax principalName principalEmail courseCatalog "
              "validation_errors").split()
    _file("lines_school", "school", all_quoted(school), [(c, "q", "") for c in school],
          "row_type NULLS LAST, TRY_CAST(regexp_extract(schoolNum, '[0-9]+') AS BIGINT) NULLS LAST, schoolNum NULLS LAST, ")
    quoted = {"courseName", "gradeLevel", "score", "additionalKey", "storedCode", "comments", "sourceTable", "reviewReason", "validation_errors"}
    transcript = ("row_type studentNum courseNum courseName endYear gradeLevel score percent creditsEarned creditsAttempted gpaWeight "
                  "weightedGPAValue unweightedGPAValue actualTerm additionalKey storedCode dateStored comments sourceTable reviewReason "
                  "validation_errors").split()
    decimals = {"percent", "creditsEarned", "creditsAttempted", "gpaWeight", "weightedGPAValue", "unweightedGPAValue"}
    _file("lines_transcript", "transcript", ",".join(transcript),
          [(c, "q" if c in quoted else "bare", "%Y-%m-%d" if c == "dateStored" else "decimal" if c in decimals else "") for c in transcript],
          "".join(f"{c} NULLS LAST, " for c in ("studentNum", "courseNum", "endYear", "actualTerm", "additionalKey")))
    task = [("row_type", "bare"), ("taskName", "q"), ("taskCode", "optional"), ("taskSeq", "bare"), ("postToTranscript", "bare"),
            ("sourceStoreCode", "optional"), ("validation_errors", "q")]
    _file("lines_grading_task", "gradingTask", ",".join(c for c, _ in task), [(c, how, "") for c, how in task],
          "taskSeq NULLS LAST, taskName NULLS LAST, taskCode NULLS LAST, ")
    standards = ("recordType STANDARDID PARENTSTANDARDID LONGITUDINALID YEARID NAME DESCRIPTION IDENTIFIER SUBJECTAREA CONVERSIONSCALE "
                 "GRADESCALEITEMDCID ISASSIGNMENTALLOWED ISACTIVE DEACTIVATEDATE DISPLAYPOSITION ISCOMMENTINCLUDED MAXCOMMENTLENGTH "
                 "ISEXCLUDEDFROMREPORTS IMPORTBATCHTRACKING PSGUID WHOCREATED WHENCREATED WHOMODIFIED WHENMODIFIED TRANSIENTCOURSELIST "
                 "EXTERNALID PARENTSTANDARDID_NVL").split()
    times = {"DEACTIVATEDATE", "WHENCREATED", "WHENMODIFIED"}
    _file("lines_standards", "standards", ",".join(standards),
          [(c, "bare" if c == "recordType" else "stored", "%Y-%m-%d %H:%M:%S" if c in times else "") for c in standards], "")


# ---- integrity: keys and references as the scripts' headers state them ----------------

UNIQUE_KEYS = {
    "department": "schoolNum departmentName", "room": "roomNumber schoolNum", "courseRequest": "studentNumber courseNumber schoolNum",
    "employment": "employNum schoolNum startDate assignmentCode", "homeless": "studentNum startDate", "attendanceAggregate": "studentNum date",
    "dentalScreening": "studentNum date", "developmentalScreening": "studentNum date", "earlyChildhoodScreening": "studentNum date",
    "hearingScreening": "studentNum date", "healthWeightScreening": "studentNum date", "leadScreening": "studentNum date",
    "scoliosisScreening": "studentNum date", "visionScreening": "studentNum date",
}
REFERENCES = [("department", "schoolNum", "school", "schoolNum"), ("room", "schoolNum", "school", "schoolNum"),
              ("courseRequest", "studentNumber", "student", "studentNum"), ("courseRequest", "courseNumber", "course", "courseNum"),
              ("courseRequest", "schoolNum", "school", "schoolNum")]


def _integrity_later():
    names = sorted(set(UNIQUE_KEYS) | {x for c, _, p, _ in REFERENCES for x in (c, p)})
    parts = []
    for f, cols in UNIQUE_KEYS.items():
        key = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cols.split())
        parts.append(f"SELECT 'DUPLICATE_KEY' AS kind, '{f}' AS file, '{','.join(cols.split())}' AS \"check\", {key} AS key, count(*) AS n "
                     f"FROM f_{f} WHERE {' OR '.join(f'{c} IS NOT NULL' for c in cols.split())} GROUP BY {key} HAVING count(*) > 1")
    for f, c, parent, pc in REFERENCES:
        parts.append(f"SELECT 'MISSING_PARENT', '{f}', '{c} -> {parent}', CAST({c} AS VARCHAR), count(*) FROM f_{f} "
                     f"WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM f_{parent} WHERE {pc} IS NOT NULL) GROUP BY {c}")
    register("integrity_findings", "WITH " + ",\n".join(_wrap(n, f"f_{n}") for n in names) + "\n" + "\nUNION ALL\n".join(parts))
    for name in ("roster", "enrollment"):
        register(f"school_filter_{name}", "WITH " + _wrap(name, "e") + """
SELECT * FROM e WHERE schoolNum IN (SELECT CAST(school_number AS VARCHAR) FROM schools WHERE dcid = 507)""")
