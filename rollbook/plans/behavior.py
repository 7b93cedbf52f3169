"""Behaviour extracts (E26–E30) and special education."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import clip, col, first_nonblank, one_line
from rollbook.operators.quality import fallback_when, finalize, required, row_type_with_review, rule
from rollbook.operators.relational import union_all
from rollbook.params import ExtractParams
from rollbook.plans.registry import extract, of_school
from rollbook.sources.catalog import Tables

US_DATE = "MM/dd/yyyy"


def _info_when_empty(out: DataFrame, source: DataFrame, values: dict):
    """INFO marker row when the *source table* has no rows (C17, INFO policy)."""
    return fallback_when(out, values, source)


# ---- E26 behaviorEventType --------------------------------------------------------------

@extract("behaviorEventType", batch=3, order=("eventName",))
def behavior_event_type(t: Tables, p: ExtractParams) -> DataFrame:
    """Distinct event names from log subjects (or LOGTYPE_<id>) and from the
    'logtype' category of the code table (U03, a distinct union)."""
    log_names = t.log.select(F.substring(F.trim(first_nonblank(
        "subject", default=F.concat_ws("", F.lit("LOGTYPE_"), col("logtypeid").cast("string")))), 1, 100).alias("eventName"))
    gen_names = t.gen.where(col("cat") == "logtype").select(F.substring(F.trim(first_nonblank(
        "value", "name", default=F.concat_ws("", F.lit("LOGTYPE_"), col("id").cast("string")))), 1, 100).alias("eventName"))
    src = log_names.unionByName(gen_names).distinct()
    return finalize(src, ["eventName"], [required("eventName", blank=True)])


# ---- E27 behaviorIncident ---------------------------------------------------------------

@extract("behaviorIncident", batch=3, order=("incidentID",), date_format=US_DATE, school="schoolID")
def behavior_incident(t: Tables, p: ExtractParams) -> DataFrame:
    lo, hi = F.lit(p.incident_start).cast("date"), F.lit(p.incident_end).cast("date")
    lg = of_school(t, p, t.log, "schoolid")
    ldate = F.coalesce(col("discipline_incidentdate"), col("entry_date"))
    log_src = lg.where(F.to_date(ldate).between(lo, hi)).select(
        F.substring(col("id").cast("string"), 1, 50).alias("incidentID_raw"),
        col("schoolid").cast("long").alias("schoolID_raw"),
        F.to_date(ldate).alias("incidentDate_raw"),
        F.substring("entry_time", 1, 20).alias("incidentTime_raw"),
        F.substring(F.coalesce(col("discipline_incidentlocation"), col("discipline_incidentlocdetail")), 1, 100)
        .alias("location_raw"),
        F.substring(first_nonblank(col("subject"), F.substring("entry", 1, 2000), F.substring("custom", 1, 2000)),
                    1, 2000).alias("entryText_raw"),
        col("logtypeid").cast("long").alias("logTypeID_raw"),
        F.lit(None).cast("timestamp_ntz").alias("whenCreated_raw"),
        F.lit(None).cast("timestamp_ntz").alias("whenModified_raw"))
    inc = of_school(t, p, t.incident, "school_number")
    inc_src = inc.where(F.to_date("incident_ts").between(lo, hi)).select(
        F.substring(col("incident_id").cast("string"), 1, 50).alias("incidentID_raw"),
        col("school_number").cast("long").alias("schoolID_raw"),
        F.to_date("incident_ts").alias("incidentDate_raw"),
        F.date_format("incident_ts", "HH:mm:ss").alias("incidentTime_raw"),
        F.substring("location_details", 1, 100).alias("location_raw"),
        F.nullif(F.trim(F.substring("incident_detail_desc", 1, 2000)), F.lit("")).alias("entryText_raw"),
        F.lit(None).cast("long").alias("logTypeID_raw"),
        col("created_ts").cast("timestamp_ntz").alias("whenCreated_raw"),
        col("last_modified_ts").cast("timestamp_ntz").alias("whenModified_raw"))
    x = union_all([log_src, inc_src]).select(
        clip("incidentID_raw", 50).alias("incidentID"),
        col("schoolID_raw").alias("schoolID"),
        col("incidentDate_raw").alias("incidentDate"),
        clip("incidentTime_raw", 20).alias("incidentTime"),
        clip("location_raw", 100).alias("location"),
        one_line(clip("entryText_raw", 2000)).alias("entryText"),
        col("logTypeID_raw").alias("logTypeID"),
        col("whenCreated_raw").alias("whenCreated"),
        col("whenModified_raw").alias("whenModified"))
    x = x.withColumn("reviewReason", F.when(col("incidentDate").isNull(), F.lit("NO_INCIDENT_DATE")))
    rules = [required("incidentID", blank=True), required("incidentDate")]
    return finalize(x, ["incidentID", "schoolID", "incidentDate", "incidentTime", "location", "entryText",
                        "logTypeID", "whenCreated", "whenModified", "reviewReason"], rules,
                    type_expr=row_type_with_review("validation_errors", "reviewReason"))


# ---- E28 behaviorResolution / E29 behaviorResolutionType / E30 behaviorRole ------------------------

def _resolution_name(n: int = 100):
    return F.substring(F.trim(first_nonblank("action_resolved_desc", default="INCIDENT_ACTION")), 1, n)


@extract("behaviorResolution", batch=3, order=("-row_type", "incidentID", "resolutionID"))
def behavior_resolution(t: Tables, p: ExtractParams) -> DataFrame:
    ia = t.incident_action
    lo, hi = F.lit(p.behavior_start).cast("date"), F.lit(p.behavior_end).cast("date")
    x = ia.select(
        clip(col("incident_id").cast("string"), 50).alias("incidentID"),
        clip(col("incident_action_id").cast("string"), 50).alias("resolutionID"),
        clip(_resolution_name(), 100).alias("resolutionName"),
        col("action_plan_begin_dt").alias("beginDate"),
        col("action_plan_end_dt").alias("endDate"),
        col("action_actual_resolved_dt").alias("resolvedDate"))
    first = F.to_date(F.coalesce("beginDate", "endDate", "resolvedDate"))
    rules = [required("incidentID", blank=True), required("resolutionID", blank=True),
             required("resolutionName", blank=True),
             rule("ERR_OUTSIDE_7YR_WINDOW", first.isNotNull() & ((first < lo) | (first > hi)))]
    out = finalize(x, ["incidentID", "resolutionID", "resolutionName", "beginDate", "endDate", "resolvedDate"], rules)
    return _info_when_empty(out, ia, {"row_type": "INFO",
                                      "validation_errors": "NO_SOURCE_ROWS_IN_PS.INCIDENT_ACTION"})


@extract("behaviorResolutionType", batch=3, order=("-row_type", "resolutionName"))
def behavior_resolution_type(t: Tables, p: ExtractParams) -> DataFrame:
    ia = t.incident_action
    src = ia.select(_resolution_name().alias("resolutionName")).distinct()
    out = finalize(src, ["resolutionName"], [required("resolutionName", blank=True)])
    # INFO row carries the source count; it is only emitted when that count is 0
    return _info_when_empty(out, ia, {"row_type": "INFO",
                                      "validation_errors": "NO_SOURCE_ROWS_IN_PS.INCIDENT_ACTION (COUNT=0)"})


@extract("behaviorRole", batch=3, order=("-row_type", "roleName"))
def behavior_role(t: Tables, p: ExtractParams) -> DataFrame:
    r = t.incident_person_role
    src = r.select(F.substring(F.trim(first_nonblank("person_desc", default="INCIDENT_PERSON_ROLE")), 1, 50)
                   .alias("roleName")).distinct()
    out = finalize(src, ["roleName"], [required("roleName", blank=True)])
    return _info_when_empty(out, r, {"row_type": "INFO",
                                     "validation_errors": "NO_SOURCE_ROWS_IN_PS.INCIDENT_PERSON_ROLE"})


# ---- E48 specialEducationSummary ------------------------------------------------------------

@extract("specialEducationSummary", batch=4, order=("studentNum", "startDate"), date_format=US_DATE)
def special_education_summary(t: Tables, p: ExtractParams) -> DataFrame:
    end_years = [p.active_end_year - i for i in range(p.years_of_data)]  # S04: last n end-years
    d = t.cst_pubstuspeddata.where(col("schoolyear").isin(*end_years))
    prog = d.select(
        F.substring(col("state_studentnumber"), 1, 15).alias("studentNum_raw"),
        col("begindate").alias("startDate"), col("enddate").alias("endDate"),
        F.substring(first_nonblank("exceptionalityprimary", "primaryorderofdisability", "studenteligibility",
                                   default="UNKNOWN"), 1, 50).alias("primaryDisability_raw"),
        F.coalesce("iepbegindate", "iepreviewdate").alias("iepDate"),
        col("enddate").alias("exitDate"),
        F.substring(F.nullif(F.trim("reasonfortermination"), F.lit("")), 1, 50).alias("exitReason_raw"),
        col("schoolyear").cast("int").alias("endYear"))
    x = t.s_nd_stu_x.where(F.nullif(F.trim("servingspecialedunit"), F.lit("")).isNotNull()
                           | F.nullif(F.trim("sendtotienet"), F.lit("")).isNotNull())
    s = t.students.select(col("dcid").alias("_sdcid"), "state_studentnumber")
    ext = x.join(s, col("studentsdcid") == col("_sdcid")).select(
        F.substring(col("state_studentnumber"), 1, 15).alias("studentNum_raw"),
        F.lit(None).cast("date").alias("startDate"), F.lit(None).cast("date").alias("endDate"),
        F.substring(first_nonblank("servingspecialedunit", "sendtotienet", default="ND_EXT_FLAG"), 1, 50)
        .alias("primaryDisability_raw"),
        F.lit(None).cast("date").alias("iepDate"), F.lit(None).cast("date").alias("exitDate"),
        F.lit(None).cast("string").alias("exitReason_raw"),
        F.lit(p.active_end_year).cast("int").alias("endYear"))
    src = union_all([prog, ext])
    y = src.select(
        F.substring(F.trim("studentNum_raw"), 1, 15).alias("studentNum"), "startDate", "endDate",
        clip("primaryDisability_raw", 50).alias("primaryDisability"), "iepDate", "exitDate",
        clip("exitReason_raw", 50).alias("exitReason"), "endYear")
    rules = [rule("ERR_REQUIRED_studentNum",
                  col("studentNum").isNull() | (F.length(F.regexp_replace("studentNum", r"\s", "")) == 0)),
             required("endYear")]
    out = finalize(y, ["studentNum", "startDate", "endDate", "primaryDisability", "iepDate", "exitDate",
                       "exitReason", "endYear"], rules)
    # INFO only when both source tables are empty
    probe = t.cst_pubstuspeddata.select(F.lit(1).alias("_p")).unionByName(t.s_nd_stu_x.select(F.lit(1).alias("_p")))
    return fallback_when(out, {"row_type": "INFO", "validation_errors":
                               "INFO_NO_DATA: CST_PUBSTUSPEDDATA=0, S_ND_STU_X=0; no rows available to export for requested years."},
                         probe)
