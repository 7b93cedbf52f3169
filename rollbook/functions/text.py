"""Column helpers for text, codes and small encodings (SURVEY F01–F27, C10–C15,
C19, C22, C27–C31).  Every function maps Columns to a Column built from Spark
built-ins, so it stays inside whole-stage codegen.

Blank handling follows the source system, where an empty string *is* NULL:
``clip`` returns NULL for blank input, and concatenation skips NULL parts.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: ColumnOrName) -> Column:
    return col(c).cast("string")


def blank_to_null(c: ColumnOrName) -> Column:
    """'' or all-space text -> NULL (F15 ``NULLIF(TRIM(x),'')``), value kept otherwise."""
    c = as_text(c)
    return F.when(F.trim(c) != "", c)


def clip(c: ColumnOrName, n: int | None = None) -> Column:
    """Trim, cut to ``n`` characters, blank -> NULL."""
    t = F.trim(as_text(c))
    if n is not None:
        t = F.substring(t, 1, n)
    return F.nullif(t, F.lit(""))


def cat(*parts: ColumnOrName | str) -> Column:
    """F04 ``a || b``: NULL parts are skipped (not NULL-propagating).  Plain
    Python strings are literals."""
    cols = [F.lit(p) if isinstance(p, str) else p for p in parts]
    return F.nullif(F.concat_ws("", *cols), F.lit(""))


def is_blank(c: ColumnOrName) -> Column:
    c = as_text(c)
    return c.isNull() | (F.trim(c) == "")


def contains_any(c: ColumnOrName, words: Iterable[str]) -> Column:
    """P10/C14: ``UPPER(x) LIKE '%W%' OR ...`` (substring semantics kept)."""
    u = F.upper(as_text(c))
    return reduce(lambda a, b: a | b, [u.contains(w) for w in words])


def first_nonblank(*cols: ColumnOrName, default: ColumnOrName | str | None = None) -> Column:
    """First non-blank (trimmed) of several columns, else ``default``."""
    opts = [F.nullif(F.trim(as_text(c)), F.lit("")) for c in cols]
    if default is not None:
        opts.append(F.lit(default) if isinstance(default, str) else col(default))
    return F.coalesce(*opts)


def pad_grade(c: ColumnOrName) -> Column:
    """A single digit is left-padded to two, everything else is trimmed."""
    t = F.trim(as_text(c))
    return F.nullif(F.when(t.rlike(r"^[0-9]$"), F.lpad(t, 2, "0")).otherwise(t), F.lit(""))


def grade_sequence(c: ColumnOrName) -> Column:
    """C11: PK -> 4, K/KG -> 5, numeric n -> n + 5, anything else NULL."""
    t = F.upper(F.trim(as_text(c)))
    n = t.try_cast("int")
    return (
        F.when(t == "PK", F.lit(4))
        .when(t.isin("K", "KG"), F.lit(5))
        .when(t.rlike(r"^-?[0-9]+$"), n + 5)
    )


def household_key(street: ColumnOrName, city: ColumnOrName, zipc: ColumnOrName) -> Column:
    """``UPPER(street)|UPPER(city)|zip`` with empty parts kept as ''."""
    return F.concat(
        F.coalesce(F.upper(as_text(street)), F.lit("")), F.lit("|"),
        F.coalesce(F.upper(as_text(city)), F.lit("")), F.lit("|"),
        F.coalesce(as_text(zipc), F.lit("")),
    )


def hhmm(seconds: ColumnOrName) -> Column:
    """Seconds since midnight -> ``HH:MM``."""
    s = col(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(s / 3600).cast("int"), F.floor((s % 3600) / 60).cast("int"))


def lunch_status_code(c: ColumnOrName) -> Column:
    """1/F/FREE -> F, 2/R/REDUCED -> R, else NULL."""
    u = F.upper(F.trim(as_text(c)))
    return F.when(u.isin("1", "F", "FREE"), "F").when(u.isin("2", "R", "REDUCED"), "R")


def default_phone(c: ColumnOrName, n: int = 25) -> Column:
    """Blank phone -> 999-999-9999."""
    return F.coalesce(clip(c, n), F.lit("999-999-9999"))


def no_show(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Enrolment that ends the day it starts."""
    return F.when(col(start) == col(end), F.lit("1"))


def gpa_weight(excluded: ColumnOrName, potential: ColumnOrName) -> Column:
    """Credit weight is 0 when the grade is excluded from GPA."""
    return F.when(F.coalesce(col(excluded), F.lit(0)) == 1, F.lit(0)).otherwise(col(potential))


def score_value(*cols: ColumnOrName) -> Column:
    """First non-NULL of several scores, as text."""
    return F.coalesce(*[as_text(c) for c in cols])


def one_line(c: ColumnOrName) -> Column:
    """CR / LF -> space so a field never breaks a CSV line."""
    return F.translate(as_text(c), "\r\n", "  ")


def yearid_of_termid(termid: ColumnOrName) -> Column:
    """termid = yearid*100 + n  ->  yearid (floor division, as FLOOR(t/100))."""
    return F.floor(col(termid) / 100).cast("int")


def termid_in_years(termid: ColumnOrName, lo: Column | int, hi: Column | int) -> Column:
    """``FLOOR(termid/100) BETWEEN lo AND hi`` rewritten on the raw key, so a
    literal bound reaches the parquet scan: termid in [lo*100, (hi+1)*100)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    t = col(termid)
    return (t >= lo_c * 100) & (t < (hi_c + 1) * 100)


def number_text(c: ColumnOrName) -> Column:
    """Number -> text as the source system writes it: no trailing fractional zeros and no zero
    before the point (12.50 -> 12.5, 5.00 -> 5, 0.50 -> .5, -0.25 -> -.25)."""
    s = col(c).cast("string")
    s = F.regexp_replace(F.regexp_replace(s, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.regexp_replace(s, r"^(-?)0\.", "$1.")
