"""Keys and references across files as one graph.

Files declare a unique key and the references that their rows make to other files'
columns.  All checks run in one keyed pass: every row gives one item for each check it
takes part in, as a child or as a parent, and the items are counted by (check, key).
A file is computed once however many checks name it, there is one shuffle in all, and a
key that very many rows share shrinks in the map task.

Rows that are only a marker (no key column filled) take no part in checks of uniqueness.  A
reference with a NULL column refers to nothing and is not checked.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DUPLICATE, MISSING = "DUPLICATE_KEY", "MISSING_PARENT"
#: Between the parts of a key in a report, and in place of a NULL part.
PART, NULL = "|", "~"


@dataclass(frozen=True)
class UniqueKey:
    file: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{','.join(self.columns)} -> {self.parent}"


def declared(specs: Iterable) -> list[UniqueKey | Reference]:
    """The checks that extracts of the registry declare (``key``, ``refs``)."""
    out: list[UniqueKey | Reference] = []
    for s in specs:
        if s.key:
            out.append(UniqueKey(s.name, tuple(s.key)))
        out += [Reference(s.name, (c,), parent, (pc,)) for c, parent, pc in s.refs]
    return out


def _key(columns: tuple[str, ...]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("string") for c in columns])


def _item(kind: str, file: str, name: str, columns: tuple[str, ...], child: bool, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(file).alias("file"), F.lit(name).alias("check"), _key(columns).alias("key"),
                                 F.lit(int(child)).alias("child"), F.lit(int(not child)).alias("parent")))


def _filled(columns: tuple[str, ...], all_of: bool) -> Column:
    tests = [F.col(f"`{c}`").isNotNull() for c in columns]
    return reduce(lambda a, b: a & b if all_of else a | b, tests)


def _items(file: str, df: DataFrame, checks: list) -> DataFrame | None:
    items = []
    for c in checks:
        if isinstance(c, UniqueKey):
            if c.file == file:
                items.append(_item(DUPLICATE, file, ",".join(c.columns), c.columns, True, _filled(c.columns, all_of=False)))
            continue
        if c.child == file:
            items.append(_item(MISSING, c.child, c.name, c.columns, True, _filled(c.columns, all_of=True)))
        if c.parent == file:
            items.append(_item(MISSING, c.child, c.name, c.parent_columns, False, _filled(c.parent_columns, all_of=True)))
    return df.select(F.explode(F.array_compact(F.array(*items))).alias("i")).select("i.*") if items else None


def findings(frames: Mapping[str, DataFrame], checks: Iterable[UniqueKey | Reference]) -> DataFrame:
    """``kind``, ``file``, ``check``, ``key`` (text) and ``n``: keys that ``n`` rows share, and references
    of ``n`` rows to a parent that is not there.  ``frames`` holds every file that a check names."""
    checks = list(checks)
    parts = [p for name, df in frames.items() if (p := _items(name, df, checks)) is not None]
    counts = (reduce(lambda a, b: a.unionByName(b), parts).groupBy("kind", "file", "check", "key")
              .agg(F.sum("child").alias("n"), F.sum("parent").alias("parents")))
    wrong = ((F.col("kind") == DUPLICATE) & (F.col("n") > 1)) | ((F.col("kind") == MISSING) & (F.col("n") > 0) & (F.col("parents") == 0))
    return counts.where(wrong).select("kind", "file", "check", F.array_join("key", PART, NULL).alias("key"), "n")
