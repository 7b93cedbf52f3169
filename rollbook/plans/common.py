"""Shared frames used by several extracts (key map, year-record calendars)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import col
from rollbook.operators.relational import dimension, school_key_map
from rollbook.operators.years import active_year_from_sections, calendar_name_start, school_year_end
from rollbook.sources.catalog import Tables

SENTINEL_SCHOOL = 999999


def key_map(t: Tables, extra=()) -> DataFrame:
    """C03 over ``schools`` (bounded by the number of schools)."""
    return school_key_map(t.schools, extra=extra)


def yearrec_calendars(t: Tables) -> DataFrame:
    """Year-record terms per school with the start-year calendar name.
    Columns: schoolNum_raw (string), year_termid, startDate_dt, endDate_dt,
    school_year_end_year, calendarName_raw.  Stored once per catalog."""
    return t.stored("yearrec_calendars", lambda: _yearrec_calendars(t))


def _yearrec_calendars(t: Tables) -> DataFrame:
    skm = key_map(t)
    terms = t.terms.where(col("isyearrec") == 1)
    y = (terms.join(dimension(skm), terms["schoolid"] == skm["school_key"])
         .where(col("schoolNum").isNotNull() & (col("schoolNum") != SENTINEL_SCHOOL)))
    return y.select(
        col("schoolNum").cast("string").alias("schoolNum_raw"),
        col("id").alias("year_termid"),
        col("firstday").alias("startDate_dt"),
        col("lastday").alias("endDate_dt"),
        school_year_end(col("firstday")).alias("school_year_end_year"),
        calendar_name_start(col("firstday"), F.substring(col("schoolName"), 1, 60)).alias("calendarName_raw"),
    )


def section_keys(t: Tables) -> DataFrame:
    """The columns of ``sections`` that say which school, term, course and room a section is in,
    stored once per catalog: the year of the sections and every extract over their keys read this
    narrow relation, so ``sections`` itself is scanned once."""
    return t.stored("section_keys", lambda: t.sections.select("id", "schoolid", "termid", "course_number", "room"))


def term_years(t: Tables) -> DataFrame:
    """(termid, yearid) pairs; terms.id may repeat across schools, so de-dup
    before joining to keep the big side from fanning out.  One row per term kind and year."""
    return t.stored("term_years", lambda: t.terms.select(col("id").alias("_tid"), col("yearid").alias("_tyear")).distinct())


def section_year(t: Tables) -> Column:
    """Newest yearid used by any section, as a scalar subquery."""
    return active_year_from_sections(section_keys(t), t.terms).scalar()


def section_keys_in_year(t: Tables, y: Column) -> DataFrame:
    """Section keys whose term (by id) belongs to yearid ``y``."""
    return section_keys(t).join(dimension(term_years(t).where(col("_tyear") == y)), col("termid") == col("_tid"), "left_semi")
