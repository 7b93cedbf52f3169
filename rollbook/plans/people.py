"""People extracts: student (E14), contact (E15), employee (E16), userAccount
(E17), employment (E18) and the documented student roster extract (E74).

Multi-valued attributes (e-mails, races, phones, addresses) are folded per
person with one ``groupBy`` each (A08–A10) *before* the join to students, so
the student frame is joined to one row per person, never to the raw lists.
Each list is bounded per person (a handful of e-mails / races / phones).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, household_key
from rollbook.operators.quality import empty_fallback, finalize, required, rule
from rollbook.operators.relational import (
    active_as_of, dedup_first, dimension, listagg_ordered, pivot_conditional_max, salted_join, school_filter, union_all)
from rollbook.params import ExtractParams
from rollbook.plans.registry import extract, of_school
from rollbook.sources.catalog import Tables

US_DATE = "MM/dd/yyyy"

# federal race code labels (fixed values)
RACE_LABELS = {
    "B": "Black",
    "W": "White",
    "A": "Asian",
    "I": "American Indian or Alaska Native",
    "P": "Native Hawaiian or Other Pacific Islander",
}
# system accounts that are not staff (fixed values)
SYSTEM_LAST_NAMES = ("POWERSCHOOL", "SYSTEM")
# address kinds in the code table (fixed values)
PHYSICAL, MAILING = 19, 20
# widths of the folded list columns in the student file
EMAIL_WIDTH, RACE_WIDTH = 255, 200


def active_students(t: Tables, p: ExtractParams) -> DataFrame:
    s = t.students.where(col("student_number").isNotNull() & (col("student_number") != 0))
    return active_as_of(s, "entrydate", "exitdate", p.as_of_date)


def _nz(c):
    """Oracle NULLIF(x, '')."""
    return F.nullif(col(c), F.lit(""))


# ---- E14 student ------------------------------------------------------------------

def race_lists(t: Tables) -> DataFrame:
    """A10: decoded race labels joined by '; ', ordered by the raw code."""
    label = F.coalesce(*[F.when(col("racecd") == k, F.lit(v)) for k, v in RACE_LABELS.items()], col("racecd"))
    return listagg_ordered(t.studentrace, ["studentid"], label, [col("racecd")], alias="race_list",
                           max_chars=RACE_WIDTH)


def email_lists(t: Tables) -> DataFrame:
    """The e-mails of each row of person by priority (NULL priority last, then address)."""
    pea = t.personemailaddressassoc.join(t.person.select(col("id").alias("personid")), "personid", "left_semi")
    e = t.emailaddress.select(col("emailaddressid").alias("_eid"), "emailaddress")
    j = pea.join(e, pea["emailaddressid"] == e["_eid"])
    pr = col("emailaddresspriorityorder")
    return listagg_ordered(j, ["personid"], col("emailaddress"),
                           [pr.isNull().cast("int"), pr, col("emailaddress")], alias="email_list",
                           max_chars=EMAIL_WIDTH)


@extract("student", batch=2, order=("studentNum",), date_format=US_DATE)
def student(t: Tables, p: ExtractParams) -> DataFrame:
    b = active_students(t, p)
    nd = t.s_nd_stu_x.select(col("studentsdcid").alias("_nd"), "legalfirstname", "legalmiddlename",
                             "legallastname", "legalgender")
    core = t.studentcorefields.select(col("studentsdcid").alias("_core"), "pscore_legal_last_name",
                                      "pscore_legal_first_name", "pscore_legal_middle_name", "pscore_legal_suffix",
                                      "pscore_legal_gender")
    race = race_lists(t)
    mail = email_lists(t)
    j = (b.join(nd, b["dcid"] == nd["_nd"], "left")
         .join(core, b["dcid"] == core["_core"], "left")
         .join(race, b["id"] == race["studentid"], "left")
         .join(mail, b["person_id"] == mail["personid"], "left"))
    x = j.select(
        clip(col("student_number").cast("string"), 20).alias("studentNum"),
        clip("email_list", EMAIL_WIDTH).alias("emailAddress"),
        clip(household_key(F.trim("mailing_street"), F.trim("mailing_city"), F.trim("mailing_zip")), 200)
        .alias("householdKey"),
        clip("street", 100).alias("physicalAddress"),
        clip("city", 50).alias("physicalCity"),
        clip("state", 2).alias("physicalState"),
        clip("zip", 10).alias("physicalZip"),
        clip("mailing_street", 100).alias("mailingAddress"),
        clip("mailing_city", 50).alias("mailingCity"),
        clip("mailing_state", 2).alias("mailingState"),
        clip("mailing_zip", 10).alias("mailingZip"),
        clip(F.substring(F.trim("fedethnicity"), 1, 1), 1).alias("hispanicFlag"),
        clip(F.coalesce(_nz("pscore_legal_last_name"), col("last_name")), 100).alias("lastName"),
        clip(F.coalesce(_nz("pscore_legal_first_name"), col("first_name")), 100).alias("firstName"),
        clip(F.coalesce(_nz("pscore_legal_middle_name"), col("middle_name")), 100).alias("middleName"),
        clip("pscore_legal_suffix", 20).alias("suffix"),
        clip(F.coalesce(_nz("legallastname"), col("last_name")), 100).alias("legalLastName"),
        clip(F.coalesce(_nz("legalfirstname"), col("first_name")), 100).alias("legalFirstName"),
        clip(F.coalesce(_nz("legalmiddlename"), col("middle_name")), 100).alias("legalMiddleName"),
        clip(F.substring(F.coalesce(_nz("pscore_legal_gender"), _nz("legalgender"), col("gender")), 1, 2), 2)
        .alias("legalGender"),
        col("dob").alias("birthDate"),
        clip(F.substring(F.trim("gender"), 1, 1), 1).alias("gender"),
        clip("race_list", RACE_WIDTH).alias("raceCD"),
        clip("home_phone", 30).alias("homePhone"),
    )
    rules = [("ERR_REQUIRED_studentNumber", x["studentNum"].isNull()), required("lastName", blank=True),
             required("firstName", blank=True), required("birthDate"),
             rule("ERR_INVALID_gender", ~col("gender").isin("M", "F"))]
    cols = [c for c in x.columns]
    return finalize(x, cols, rules, type_col="record_status")


# links of one person from which its join is spread over tasks
HOT_LINKS = 10_000


# ---- E15 contact --------------------------------------------------------------------

def contact_phones(t: Tables) -> DataFrame:
    """Primary (priority 1 or preferred) and secondary (priority 2) phone."""
    ph = t.personphonenumberassoc
    v = F.trim("phonenumberasentered")
    return pivot_conditional_max(ph, ["personid"], {
        "primary_phone": ((col("phonenumberpriorityorder") == 1) | (col("ispreferred") == 1), v),
        "secondary_phone": (col("phonenumberpriorityorder") == 2, v),
    })


def contact_addresses(t: Tables) -> DataFrame:
    """Current (no end date, priority 1) physical and mailing address per person."""
    paa = t.personaddressassoc.where(col("enddate").isNull() & (col("addresspriorityorder") == 1))
    pa = t.personaddress.select(col("personaddressid").alias("_paid"), "street", "city", "postalcode",
                                "statescodesetid")
    states = t.codeset.select(col("codesetid").alias("_stid"), col("displayvalue").alias("_state"))
    j = (paa.join(pa, paa["personaddressid"] == pa["_paid"])
         .join(dimension(states), col("statescodesetid") == col("_stid"), "left"))
    out = {}
    for prefix, kind in (("phys", PHYSICAL), ("mail", MAILING)):
        is_kind = col("addresstypecodesetid") == kind
        out[f"{prefix}_street"] = (is_kind, F.trim("street"))
        out[f"{prefix}_city"] = (is_kind, F.trim("city"))
        out[f"{prefix}_state"] = (is_kind, col("_state"))
        out[f"{prefix}_zip"] = (is_kind, F.trim("postalcode"))
    return pivot_conditional_max(j, ["personid"], out)


@extract("contact", batch=2, order=("studentNum", "contactKey"), date_format=US_DATE)
def contact(t: Tables, p: ExtractParams) -> DataFrame:
    ast = active_students(t, p).select(col("dcid").alias("_sdcid"), "student_number")
    sca = t.studentcontactassoc
    pe = t.person.select(col("id").alias("_pid"), "lastname", "firstname", "middlename", "suffixcodesetid",
                        "gendercodesetid")
    scd = t.studentcontactdetail.withColumnRenamed("studentcontactassocid", "_scd")
    gender = t.codeset.select(col("codesetid").alias("_gid"), col("displayvalue").alias("_gdv"))
    rel = t.codeset.select(col("codesetid").alias("_rid"), col("code").alias("_rcode"))
    addr = contact_addresses(t).withColumnRenamed("personid", "_apid")
    phones = contact_phones(t).withColumnRenamed("personid", "_phid")
    # one row per person with all that hangs on it; the links meet it in one join, in which a person
    # linked to very many students is spread over tasks
    persons = (pe.join(addr, pe["_pid"] == addr["_apid"], "left").join(phones, pe["_pid"] == phones["_phid"], "left")
               .drop("_apid", "_phid"))
    j = (ast.join(salted_join(sca, persons, "personid", "_pid", ["studentcontactassocid", "studentdcid"], hot_rows=HOT_LINKS),
                  col("studentdcid") == ast["_sdcid"])
         .join(scd, scd["_scd"] == col("studentcontactassocid"), "left")
         .join(dimension(gender), col("_gid") == col("gendercodesetid"), "left")
         .join(dimension(rel), col("_rid") == col("currreltypecodesetid"), "left"))
    g = F.upper(col("_gdv"))
    return j.select(
        F.lit("CLEAN").alias("recordType"),
        F.substring(col("student_number").cast("string"), 1, 15).alias("studentNum"),
        F.substring(col("personid").cast("string"), 1, 200).alias("contactKey"),
        F.trim("lastname").alias("lastName"),
        F.trim("firstname").alias("firstName"),
        F.trim("middlename").alias("middleName"),
        col("suffixcodesetid").cast("string").alias("suffix"),
        F.when(g.startswith("M"), "M").when(g.startswith("F"), "F").alias("gender"),
        col("contactpriorityorder").alias("contactSeq"),
        col("_rcode").alias("relationship"),
        col("receivesmailflg").alias("mailingFlag"),
        col("liveswithflg").alias("livesWithFlag"),
        col("iscustodial").alias("guardianFlag"),
        col("isemergency").alias("emergency"),
        col("isactive").alias("isActive"),
        F.when(col("isactive") == 1, F.lit(None).cast("date")).otherwise(F.lit(p.as_of_date).cast("date"))
        .alias("endDate"),
        household_key(col("mail_street"), col("mail_city"), col("mail_zip")).alias("householdKey"),
        col("phys_street").alias("physicalAddress"), col("phys_city").alias("physicalCity"),
        col("phys_state").alias("physicalState"), col("phys_zip").alias("physicalZip"),
        col("mail_street").alias("mailingAddress"), col("mail_city").alias("mailingCity"),
        col("mail_state").alias("mailingState"), col("mail_zip").alias("mailingZip"),
        col("primary_phone").alias("primaryPhone"), col("secondary_phone").alias("secondaryPhone"),
    )


# ---- E16 employee ---------------------------------------------------------------------

def staff_users(t: Tables) -> DataFrame:
    return t.users.where(~F.coalesce(F.upper("last_name"), F.lit("X")).isin(*SYSTEM_LAST_NAMES))


def employ_num(c_teacher="teachernumber", c_dcid="dcid"):
    return F.coalesce(col(c_teacher).cast("string"), col(c_dcid).cast("string"))


@extract("employee", batch=2, order=("employNum",), date_format=US_DATE)
def employee(t: Tables, p: ExtractParams) -> DataFrame:
    u = staff_users(t)
    x = u.select(
        clip(F.substring(employ_num(), 1, 15), 15).alias("employNum"),
        clip(F.substring("last_name", 1, 50), 50).alias("lastName"),
        clip(F.substring("first_name", 1, 50), 50).alias("firstName"),
        F.to_date("whencreated").alias("districtStartDate"),
        clip(F.substring("middle_name", 1, 50), 50).alias("middleName"),
        clip(F.substring("email_addr", 1, 150), 150).alias("email"),
    )
    d = dedup_first(x, ["employNum"], [col("districtStartDate").asc_nulls_last(), col("lastName").asc_nulls_last(),
                                       col("firstName").asc_nulls_last(), col("middleName").asc_nulls_last(),
                                       col("email").asc_nulls_last()])
    rules = [required("employNum", blank=True), required("lastName", blank=True), required("firstName", blank=True),
             required("districtStartDate")]
    return finalize(d, ["employNum", "lastName", "firstName", "districtStartDate", "middleName", "email"], rules)


# ---- E17 userAccount -----------------------------------------------------------------------

# day serials count from this date; 0 and -1 mean "no limit" (fixed values)
SERIAL_EPOCH = "1899-12-30"
NO_LIMIT = (0, -1)


def serial_date(c) -> F.Column:
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), col(c).cast("int"))


def login_window_open(start: str, end: str, as_of) -> F.Column:
    """Nullable / sentinel day-serial login window contains ``as_of``."""
    d = F.lit(as_of).cast("date")
    ok_start = col(start).isNull() | col(start).isin(*NO_LIMIT) | (serial_date(start) <= d)
    ok_end = col(end).isNull() | col(end).isin(*NO_LIMIT) | (serial_date(end) >= d)
    return ok_start & ok_end


@extract("userAccount", batch=2, order=("userName",))
def user_account(t: Tables, p: ExtractParams) -> DataFrame:
    u = staff_users(t)
    login = F.coalesce(col("teacherloginid"), col("loginid"))
    staff = u.where(login.isNotNull() & (F.trim(login) != "") & login_window_open("allowloginstart", "allowloginend",
                                                                                 p.as_of_date)).select(
        F.substring(employ_num(), 1, 15).alias("employNum_raw"),
        F.lit(None).cast("string").alias("studentNum_raw"),
        F.lower(F.trim(login)).alias("userName_raw"),
        F.lit("STAFF").alias("accountType"), F.lit(1).alias("acct_priority"))
    web = F.coalesce(col("student_web_id"), col("web_id"))
    studs = active_students(t, p).where(web.isNotNull() & (F.trim(web) != "")).select(
        F.lit(None).cast("string").alias("employNum_raw"),
        F.substring(col("student_number").cast("string"), 1, 15).alias("studentNum_raw"),
        F.lower(F.trim(web)).alias("userName_raw"),
        F.lit("STUDENT").alias("accountType"), F.lit(2).alias("acct_priority"))
    x = union_all([staff, studs]).select(
        F.substring(F.trim("employNum_raw"), 1, 15).alias("employNum"),
        F.substring(F.trim("studentNum_raw"), 1, 15).alias("studentNum"),
        clip("userName_raw", 50).alias("userName"),
        F.lit(None).cast("string").alias("password"),
        "accountType", "acct_priority")
    d = dedup_first(x, ["userName"], [col("acct_priority").asc(), col("employNum").asc_nulls_last(),
                                      col("studentNum").asc_nulls_last()])
    rules = [required("userName", blank=True),
             rule("ERR_INVALID_employNum_blank", col("employNum").isNotNull() & (F.length(F.trim("employNum")) == 0)),
             rule("ERR_INVALID_studentNum_blank", col("studentNum").isNotNull() & (F.length(F.trim("studentNum")) == 0)),
             rule("ERR_BOTH_employNum_and_studentNum_set", col("employNum").isNotNull() & col("studentNum").isNotNull())]
    return finalize(d, ["employNum", "studentNum", "userName", "password", "accountType"], rules)


# ---- E18 employment ----------------------------------------------------------------------

@extract("employment", batch=2, date_format=US_DATE, key=("employNum", "schoolNum", "startDate", "assignmentCode"),
         school="schoolNum")
def employment(t: Tables, p: ExtractParams) -> DataFrame:
    yr = t.terms.where(col("isyearrec") == 1)
    # C04c over terms: the requested year if it has a year record, else the newest
    y = yr.agg(F.coalesce(F.max(F.when(col("yearid") == p.requested_yearid, col("yearid"))),
                          F.max("yearid")).alias("y")).scalar()
    year_start = yr.where(col("yearid") == y).agg(F.min("firstday").alias("s")).scalar()
    u = t.users.select(col("dcid").alias("_udcid"), "teachernumber", "ptaccess")
    sc = t.schools.select(col("school_number").alias("_sn"))
    j = (of_school(t, p, t.schoolstaff, "schoolid").join(u, col("_udcid") == col("users_dcid"))
         .join(dimension(sc), col("_sn") == col("schoolid"))
         .where((F.coalesce(col("ptaccess"), F.lit(0)) == 1) & (F.coalesce(col("status"), F.lit(1)) == 1)
                & (F.coalesce(col("staffstatus"), F.lit(1)) == 1)))
    x = j.select(
        F.substring(F.coalesce(F.nullif(F.trim("teachernumber"), F.lit("")), col("_udcid").cast("string")), 1, 15)
        .alias("employNum"),
        F.substring(F.trim(col("_sn").cast("string")), 1, 7).alias("schoolNum"),
        year_start.alias("startDate"),
        F.lit("PRIMARY").alias("assignmentCode"))
    rules = [required("employNum", blank=True), required("schoolNum", blank=True), required("startDate"),
             required("assignmentCode", blank=True)]
    out = finalize(x, ["employNum", "schoolNum", "startDate", "assignmentCode"], rules)
    return empty_fallback(out, {"row_type": "ERROR", "startDate": year_start, "assignmentCode": "PRIMARY",
                                "validation_errors": "ERR_NO_SOURCE_ROWS_FOR_EMPLOYMENT; "})


# ---- E74 student roster extract (documented only) ---------------------------------------

@extract("student_roster_extract", batch=2, order=("student_id",))
def student_roster_extract(t: Tables, p: ExtractParams) -> DataFrame:
    """Students active on ``as_of_date`` (C01), optionally for one school (C02),
    with the documented columns: ids, names, grade, school, enrol/exit dates."""
    s = school_filter(active_as_of(t.students, "entrydate", "exitdate", p.as_of_date), "schoolid", p.school_id)
    return s.select(
        col("id").alias("student_id"),
        F.trim(col("state_studentnumber")).alias("state_id"),
        col("student_number").cast("string").alias("local_id"),
        F.trim("first_name").alias("first_name"), F.trim("last_name").alias("last_name"),
        col("grade_level"), col("schoolid").alias("school_id"),
        col("entrydate").alias("enroll_date"), col("exitdate").alias("exit_date"))
