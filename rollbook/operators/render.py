"""CSV rendering.

``render_lines`` turns a typed extract frame into one text column ``line``.  Each field
has a policy, the file's own or one given for the column:

* ``text``      in double quotes, embedded quotes doubled, CR/LF as blanks; NULL is ``""``
* ``optional``  like ``text``, but NULL is nothing at all
* ``stored``    like ``text``, but CR/LF stay
* ``bare``      as it is; NULL is nothing

A file's ``quote`` says what holds for columns without a policy: ``all`` makes every
field ``text`` and quotes the header, ``text`` leaves numbers bare, ``bare`` leaves all
fields bare; both have an unquoted header.  Dates are formatted by the file's or the
column's pattern, decimals as the source writes numbers (no trailing zeros, no zero
before the point).  All of it is Column expressions: rendering is a projection inside the
same stage as the extract's last operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.functions.text import number_text

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def field_text(df: DataFrame, name: str, date_format: str = "yyyy-MM-dd",
               ts_format: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, T.DateType):
        return F.date_format(c, date_format)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, ts_format)
    if isinstance(dt, T.DecimalType):
        return number_text(c)
    return c.cast("string")


def quote(c: Column, flatten: bool = True) -> Column:
    """'"' || REPLACE(NVL(x,''), '"', '""') || '"', with CR/LF flattened."""
    v = F.coalesce(c, F.lit(""))
    if flatten:
        v = F.translate(v, "\r\n", "  ")
    return F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))


POLICIES = {
    "text": quote,
    "optional": lambda c: F.when(c.isNull(), F.lit("")).otherwise(quote(c)),
    "stored": lambda c: quote(c, flatten=False),
    "bare": lambda c: F.coalesce(c, F.lit("")),
}


def field_policy(df: DataFrame, name: str, policy: str, fields: dict | None = None) -> str:
    if fields and name in fields:
        return fields[name]
    if policy == "bare" or (policy == "text" and isinstance(df.schema[name].dataType, NUMERIC)):
        return "bare"
    return "text"


def render_lines(df: DataFrame, date_format: str = "yyyy-MM-dd", ts_format: str = "yyyy-MM-dd HH:mm:ss",
                 policy: str = "all", date_formats: dict | None = None, as_column: bool = False,
                 fields: dict | None = None):
    date_formats = date_formats or {}
    unknown = set(fields or ()) - set(df.columns)
    if unknown:
        raise ValueError(f"policies for columns that the file lacks: {sorted(unknown)}")
    parts = []
    for name in df.columns:
        txt = field_text(df, name, date_formats.get(name, date_format), ts_format)
        parts.append(POLICIES[field_policy(df, name, policy, fields)](txt))
    line = F.concat_ws(",", *parts)
    return line if as_column else df.select(line.alias("line"))


def header_line(columns, policy: str = "all") -> str:
    if policy != "all":
        return ",".join(columns)
    return ",".join('"' + c.replace('"', '""') + '"' for c in columns)
