"""School-year resolution and calendar naming (C05a–C05d).

Year resolvers return a **one-row DataFrame** with column ``yearid``; callers use
``yr.scalar()`` (an uncorrelated scalar subquery: Spark runs the tiny aggregate
once and inlines the value) or join it with ``dimension``.  Nothing is pulled
to the driver by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import col, yearid_of_termid
from rollbook.params import YEARID_BASE


def requested_or_latest_year(df: DataFrame, requested_yearid: int, termid: str = "termid",
                             yearid: Column | None = None) -> DataFrame:
    """The requested yearid when any row carries it, else the newest.
    One aggregate over ``df`` (map-side partial, one row out)."""
    y = yearid_of_termid(termid) if yearid is None else yearid
    base = df.where(col(termid).isNotNull()) if yearid is None else df.where(y.isNotNull())
    return base.agg(
        F.coalesce(F.max(F.when(y == F.lit(requested_yearid), y)), F.max(y)).cast("int").alias("yearid"))


def active_year_containing(terms: DataFrame, as_of) -> DataFrame:
    """Yearid of the best year record: one that contains ``as_of`` first,
    then the latest last day, then the largest id (TakeOrdered, not a window)."""
    d = F.lit(as_of).cast("date")
    contains = F.when((col("firstday") <= d) & (col("lastday") >= d), 0).otherwise(1)
    return (terms.where(col("isyearrec") == 1)
            .orderBy(contains.asc(), col("lastday").desc_nulls_last(), col("id").desc_nulls_last())
            .limit(1).select(col("yearid").cast("int").alias("yearid")))


def active_year_from_sections(sections: DataFrame, terms: DataFrame) -> DataFrame:
    """Newest yearid used by any section (sections join terms on termid)."""
    t = terms.select(col("id").alias("_tid"), col("yearid").alias("_y")).distinct()
    return (sections.select(col("termid")).distinct()
            .join(t, col("termid") == col("_tid"))
            .agg(F.max("_y").cast("int").alias("yearid")))


def calendar_name_start(first: Column | str, school_name: Column | str, n: int = 23,
                        strip_digits: bool = False) -> Column:
    """``YY-YY+1 <school name cut to n>`` from the start year."""
    y = F.year(col(first))
    name = F.trim(col(school_name))
    if strip_digits:
        name = F.regexp_replace(name, r"\s+[0-9]+$", "")
    return F.concat_ws("", F.substring(y.cast("string"), -2, 2), F.lit("-"),
                       F.substring((y + 1).cast("string"), -2, 2), F.lit(" "),
                       F.substring(name, 1, n))


def calendar_name_span(first: Column | str, last: Column | str, school_name: Column | str,
                       n: int = 23) -> Column:
    """``YY-YY <school name>`` from the first and last day."""
    return F.concat_ws("", F.substring(F.year(col(first)).cast("string"), -2, 2), F.lit("-"),
                       F.substring(F.year(col(last)).cast("string"), -2, 2), F.lit(" "),
                       F.substring(F.trim(col(school_name)), 1, n))


def school_year_end(first: Column | str) -> Column:
    return (F.year(col(first)) + 1).cast("int")


def yearid_to_end_year(yearid: Column | str) -> Column:
    return (col(yearid) + YEARID_BASE).cast("int")
