"""Table access.

``Tables`` is the one object every extract receives: ``t["students"]`` or
``t.students`` gives a DataFrame.  Two constructors:

* ``Tables.from_driver(spark, sf_dir)`` — the driver's parquet files plus the
  SIS-shaped views of :mod:`rollbook.sources.views` (tests, oracle, bench);
* ``Tables.from_paths(spark, {name: path})`` / ``Tables(frames)`` — a real SIS
  export, one parquet (or any DataFrame) per table.

Parquet scans stay lazy: Catalyst prunes columns and pushes filters into each
scan, so an extract that reads two columns of ``students`` reads two columns.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from rollbook.session import ensure_checkpoint_dir
from rollbook.sources import views as _views
from rollbook.sources.stored import store

_LOCK = threading.Lock()
_CACHE: dict[tuple[int, str], "Tables"] = {}


class Tables:
    def __init__(self, frames: dict[str, DataFrame], spark: SparkSession | None = None,
                 memo: dict | None = None):
        self._frames = dict(frames)
        self.spark = spark or next(iter(frames.values())).sparkSession
        # shared intermediate frames (e.g. the student scope), persisted once per
        # run when the runner turns sharing on; None = no sharing (plain plans)
        self._memo = memo
        self._memo_lock = threading.Lock()
        # relations derived once from this catalog's tables and stored
        self._stored: dict = {}
        self._values: dict = {}

    def shared(self, key, build) -> DataFrame:
        """``build()`` once per key when sharing is on (persisted, memory then
        disk; lost blocks are recomputed from lineage), else a fresh plan."""
        if self._memo is None:
            return build()
        with self._memo_lock:
            df = self._memo.get(key)
            if df is None:
                from pyspark import StorageLevel
                df = build().persist(StorageLevel.MEMORY_AND_DISK)
                self._memo[key] = df
            return df

    def stored(self, key, build) -> DataFrame:
        """``build()`` once per key and catalog, stored in the shared folder: a reduced relation
        that several extracts start from instead of the table itself."""
        with self._memo_lock:
            if key not in self._stored:
                self._stored[key] = store(build(), str(key))
            return self._stored[key]

    def value(self, key, build):
        """A small value derived once from this catalog's tables."""
        if key not in self._values:
            self._values[key] = build()
        return self._values[key]

    def with_sharing(self) -> "Tables":
        out = Tables(self._frames, self.spark, memo={})
        out._stored, out._values = self._stored, self._values
        return out

    def release_shared(self) -> None:
        if self._memo:
            for df in self._memo.values():
                df.unpersist()
            self._memo.clear()

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self._frames[name]
        except KeyError:
            raise KeyError(f"table {name!r} is not in this catalog") from None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __contains__(self, name: str) -> bool:
        return name in self._frames

    def names(self) -> list[str]:
        return sorted(self._frames)

    def with_tables(self, **frames: DataFrame) -> "Tables":
        out = dict(self._frames)
        out.update(frames)
        return Tables(out, self.spark, memo=None if self._memo is None else {})

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str]) -> "Tables":
        return cls({n: spark.read.parquet(p) for n, p in paths.items()}, spark)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names=None) -> "Tables":
        """Tables registered in the session catalog (e.g. a metastore database
        holding the SIS export).  ``names`` defaults to every table there."""
        if names is None:
            names = [t.name for t in spark.catalog.listTables(database)]
        return cls({n: spark.table(f"{database}.{n}") for n in names}, spark)

    @classmethod
    def from_dir(cls, spark: SparkSession, root: str, names) -> "Tables":
        """One parquet dataset per table under ``root`` (``root/<name>``)."""
        return cls({n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}, spark)

    @classmethod
    def install(cls, spark: SparkSession, sf_dir: str, tables: "Tables") -> None:
        """Make ``from_driver(spark, sf_dir)`` return ``tables`` (e.g. after the
        derived views were materialised once)."""
        with _LOCK:
            _CACHE[(id(spark), sf_dir)] = tables

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        """Driver tables + derived SIS views.  Views are analysed once here; the
        resulting DataFrames keep their resolved plans, so loading another
        scale factor later in the same session does not disturb them."""
        key = (id(spark), sf_dir)
        with _LOCK:
            hit = _CACHE.get(key)
            if hit is not None:
                return hit
            frames: dict[str, DataFrame] = {}
            for t in _views.DRIVER_TABLES:
                df = spark.read.parquet(f"{sf_dir}/{t}.parquet")
                df.createOrReplaceTempView(t)
                frames[t] = df
            ensure_checkpoint_dir(spark)
            for name, _ in _views.VIEWS:
                df = spark.sql(_views.VIEW_SQL[name])
                if name in _views.DIMENSION_VIEWS:
                    # small per-school dimensions read by almost every extract:
                    # derive them once and cut their lineage (reliable checkpoint
                    # in the cluster's checkpoint folder), so later plans scan a
                    # few kilobytes instead of re-deriving them in every subquery
                    df = df.checkpoint(eager=True)
                df.createOrReplaceTempView(name)
                frames[name] = df
            tables = cls(frames, spark)
            _CACHE[key] = tables
            return tables
