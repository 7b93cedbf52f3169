"""Extract registry.  Each extract is a function ``(tables, params) -> DataFrame``
returning the typed final frame (``row_type`` first, ``validation_errors`` last,
file column names), or ``Rows`` with a marker row, plus rendering metadata used only
when writing."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.operators.quality import Rows, resolved
from rollbook.params import ExtractParams
from rollbook.sources.catalog import Tables


@dataclass(frozen=True)
class SchoolKeys:
    """A school that was asked for: every identifier that rows may carry for it, and its numbers."""

    identifiers: tuple[int, ...]
    numbers: tuple[int, ...]


def school_keys(t: Tables, school_id: int) -> SchoolKeys:
    """The schools that ``school_id`` names by id, dcid or number, resolved once per catalog.
    At most three schools share one value, so a handful of numbers reaches the driver."""
    def build():
        s = t.schools.select(*[F.col(c).cast("long").alias(c) for c in ("id", "dcid", "school_number")])
        rows = s.where((F.col("id") == school_id) | (F.col("dcid") == school_id) | (F.col("school_number") == school_id)).collect()
        return SchoolKeys(tuple(sorted({v for r in rows for v in r if v is not None})),
                          tuple(sorted({r.school_number for r in rows if r.school_number is not None})))
    return t.value(("school", school_id), build)


def of_school(t: Tables, p: ExtractParams, df: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` carries any identifier of the school asked for: a list of literals
    on a raw column, which reaches the scan.  All rows when no school is asked for."""
    if p.school_id is None:
        return df
    return df.where(F.col(column).isin(*school_keys(t, p.school_id).identifiers))


ExtractFn = Callable[[Tables, ExtractParams], "DataFrame | Rows"]


@dataclass(frozen=True)
class Extract:
    name: str               # output file stem, e.g. "enrollment"
    fn: ExtractFn
    batch: int              # 1..4, as the nightly runner groups them
    order: tuple = ()       # output order (column names; "-col" = descending)
    date_format: str = "yyyy-MM-dd"
    ts_format: str = "yyyy-MM-dd HH:mm:ss"
    quote: str = "all"      # "all" | "text" (numbers bare, header unquoted) | "bare"
    fields: dict = field(default_factory=dict)  # quoting of single columns (render.POLICIES)
    date_formats: dict = field(default_factory=dict)  # per-column overrides
    key: tuple = ()         # documented unique key (C32)
    refs: tuple = ()        # documented references (C33): (column, parent file, its column)
    school: str = ""        # output column that names the school (C02)
    # False for extracts whose source system table does not exist yet: their
    # output is the typed-empty frame plus the marker row, independent of data
    reads_tables: bool = True

    def rows(self, tables: Tables, params: ExtractParams | None = None) -> DataFrame | Rows:
        """The extract as planned: nothing has run yet, and marker rows are not decided.  With a
        ``school_id`` it holds that school's rows (and rows of no school that stand for none)."""
        p = params or ExtractParams()
        out = self.fn(tables, p)
        if p.school_id is None or not self.school:
            return out
        mine = F.col(f"`{self.school}`").cast("string").isin(*map(str, school_keys(tables, p.school_id).numbers))
        if isinstance(out, Rows):
            none = F.col(f"`{self.school}`").isNull()
            return Rows(out.rows.where(mine), out.instead.where(none | mine), out.source)
        return out.where(mine)

    def __call__(self, tables: Tables, params: ExtractParams | None = None) -> DataFrame:
        return resolved(self.rows(tables, params))


REGISTRY: dict[str, Extract] = {}


def extract(name: str, batch: int, order=(), **kw):
    def deco(fn: ExtractFn) -> ExtractFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate extract {name}")
        REGISTRY[name] = Extract(name=name, fn=fn, batch=batch, order=tuple(order), **kw)
        return fn
    return deco


def all_extracts() -> dict[str, Extract]:
    # importing the plan modules fills the registry
    from rollbook.plans import (  # noqa: F401
        schools, people, enrollment, grades, behavior, health, programs)
    return dict(REGISTRY)
