"""Validation, row typing, "never silently empty" fallback rows and the
quality reports of one file (SURVEY C16–C18, C32–C34, J13/J14, U04); the checks
across files are in ``integrity``.

A rule is ``(code, condition)``; ``validate`` concatenates ``"<code>; "`` for every
rule whose condition is true, in rule order, then trims — the exact text the
import files carry in ``validation_errors``.  It is one projection: no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.text import col, is_blank
from rollbook.sources.stored import store

Rule = tuple[str, Column]

CLEAN, ERROR = "CLEAN", "ERROR"


# ---- rule constructors -------------------------------------------------------

def required(name: str, c: Column | None = None, blank: bool = False) -> Rule:
    """``ERR_REQUIRED_<name>`` when NULL (or blank, when ``blank``)."""
    c = col(name) if c is None else c
    return (f"ERR_REQUIRED_{name}", is_blank(c) if blank else c.isNull())


def rule(code: str, cond: Column) -> Rule:
    return (code, cond)


def required_all(names: Iterable[str], blank: bool = False) -> list[Rule]:
    return [required(n, blank=blank) for n in names]


# ---- C16 / C18 -------------------------------------------------------------

def error_text(rules: Sequence[Rule]) -> Column:
    """Concatenated, trimmed error codes; NULL when no rule fires."""
    if not rules:
        return F.lit(None).cast("string")
    parts = [F.when(cond, F.lit(f"{code}; ")) for code, cond in rules]
    return F.nullif(F.trim(F.concat_ws("", *parts)), F.lit(""))


def validate(df: DataFrame, rules: Sequence[Rule], out: str = "validation_errors") -> DataFrame:
    return df.withColumn(out, error_text(rules))


def with_codes(errors: Column, codes: Iterable[str], name: str = "validation_errors") -> Column:
    """The errors column with the codes it can hold, as metadata: a writer that counts them
    while it writes finds them in the schema."""
    return errors.alias(name, metadata={"codes": list(codes)})


def codes_of(df: DataFrame, errors_col: str = "validation_errors") -> list[str]:
    """Codes that ``with_codes`` put on the column, in order."""
    return list(df.schema[errors_col].metadata.get("codes", [])) if errors_col in df.columns else []


def codes_in(errors: Column | str) -> Column:
    """The codes of an errors text, as an array."""
    parts = F.transform(F.split(F.coalesce(col(errors), F.lit("")), ";"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def row_type(errors: Column | str = "validation_errors") -> Column:
    """CLEAN when no error text, else ERROR."""
    return F.when(is_blank(errors), F.lit(CLEAN)).otherwise(F.lit(ERROR))


def row_type_severity(errors: Column | str = "validation_errors", fatal: Sequence[str] = ("ERR_",)) -> Column:
    """Only fatal codes make a row ERROR; warning-only rows stay CLEAN.
    ``fatal`` lists the codes (or code prefixes) that count as fatal."""
    e = col(errors)
    hit = F.lit(False)
    for code in fatal:
        hit = hit | (F.coalesce(F.instr(e, code), F.lit(0)) > 0)
    return F.when(hit, F.lit(ERROR)).otherwise(F.lit(CLEAN))


def row_type_with_review(errors: Column | str, reason: Column | str) -> Column:
    """A review reason also forces ERROR."""
    return F.when(is_blank(errors) & is_blank(reason), F.lit(CLEAN)).otherwise(F.lit(ERROR))


def finalize(df: DataFrame, columns: Sequence[str], rules: Sequence[Rule] = (),
             type_col: str = "row_type", errors_col: str = "validation_errors",
             type_expr: Column | None = None) -> DataFrame:
    """validate -> type -> project to the file's column order
    (``type_col`` first, ``errors_col`` last)."""
    v = df.withColumn(errors_col, error_text(rules))
    t = row_type(errors_col) if type_expr is None else type_expr
    codes = [code for code, _ in rules]
    return v.select(t.alias(type_col), *[col(c) for c in columns], with_codes(col(errors_col), codes, errors_col))


# ---- C17 / J13 / U04 --------------------------------------------------------

def marker_row(df: DataFrame, values: dict) -> DataFrame:
    """One row with ``df``'s schema; columns missing in ``values`` are NULL."""
    spark = df.sparkSession
    cols = []
    for f in df.schema.fields:
        v = values.get(f.name)
        c = v if isinstance(v, Column) else F.lit(v)
        cols.append(c.cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


@dataclass(frozen=True)
class Rows:
    """An extract's rows and what stands in their place when there are none (C17).

    The rows are planned and run once.  A writer counts them as it writes and then writes
    ``instead`` if the count is 0 (the runner does that); ``resolved`` stores them and looks
    at what was stored.  With ``source`` the test is on that table instead: one row of it
    is looked for, by a scalar subquery of the same query.
    """

    rows: DataFrame
    instead: DataFrame
    source: DataFrame | None = None

    def resolved(self) -> DataFrame:
        if self.source is not None:
            found = self.source.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
            return self.rows.unionByName(self.instead.where(found == 0))
        kept = store(self.rows, "rows")
        return self.instead.select(*kept.columns) if kept.isEmpty() else kept


def empty_fallback(df: DataFrame, values: Mapping) -> Rows:
    """C17: one marker row with ``values`` when ``df`` is empty."""
    return Rows(df, marker_row(df, values))


def fallback_when(df: DataFrame, values: Mapping, source: DataFrame) -> Rows:
    """Like ``empty_fallback`` but the emptiness test is on the table ``source``."""
    return Rows(df, marker_row(df, values), source)


def resolved(out: DataFrame | Rows) -> DataFrame:
    return out.resolved() if isinstance(out, Rows) else out


# ---- C32–C34 -----------------------------------------------------------------

def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_reference(child: DataFrame, parent: DataFrame, keys: Sequence[str] | dict) -> DataFrame:
    """Child keys with no parent row (distinct)."""
    if isinstance(keys, dict):
        ck, pk = list(keys), list(keys.values())
    else:
        ck = pk = list(keys)
    p = parent.select(*[col(a).alias(f"_p_{b}") for a, b in zip(pk, ck)]).distinct()
    c = child.select(*ck).distinct()
    # NULL keys compare equal (a NULL school in both files is a match, not a gap)
    cond = [c[k].eqNullSafe(p[f"_p_{k}"]) for k in ck]
    on = cond[0]
    for x in cond[1:]:
        on = on & x
    return c.join(p, on=on, how="left_anti")


def quality_summary(df: DataFrame, extract: str, type_col: str = "row_type",
                    errors_col: str = "validation_errors") -> DataFrame:
    """Per extract, the row count of each row type and of each error code, in one pass:
    a row gives its type and its codes as items, and the items are counted."""
    item = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.alias("item"))
    items = F.array(item("row_type", col(type_col)))
    if errors_col in df.columns:
        items = F.concat(items, F.transform(codes_in(errors_col), lambda x: item("error_code", x)))
    return (df.select(F.explode(items).alias("i")).groupBy("i.kind", "i.item").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(extract).alias("extract"), "kind", "item", "n"))
