"""Relational building blocks.

Scale notes, applied throughout:

* Dimension frames (schools, the school key map, calendars, code lists) are
  bounded by the number of schools x school years, never by the number of
  students; they are the only frames we mark for broadcast (``dimension``).
* Student- and enrolment-level frames grow with the data and are never
  broadcast by us; AQE may still choose a broadcast from runtime sizes.
* Distinct-before-join: when only keys of the big side are needed, it is
  de-duplicated first (map-side partial aggregation), so a hot student or
  school shrinks before the shuffle.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions.text import col
from rollbook.sources.stored import store

#: Rows of a calendar-like frame that are broadcast at most.
BROADCAST_ROWS = 200_000

# ---- helpers -----------------------------------------------------------------


def dimension(df: DataFrame) -> DataFrame:
    """Mark a frame whose size is bounded by schools x years (or a code list)
    for broadcast.  Never use on student-level data."""
    return F.broadcast(df)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- C01 / C02 / P06 / P08 / P12 ----------------------------------------------

def active_as_of(df: DataFrame, start: str, end: str, as_of) -> DataFrame:
    """Start <= as_of and (end is null or end >= as_of)."""
    d = F.lit(as_of).cast("date")
    return df.where((col(start) <= d) & (col(end).isNull() | (col(end) >= d)))


def school_filter(df: DataFrame, column: str, school_id=None) -> DataFrame:
    """Optional single-school restriction."""
    return df if school_id is None else df.where(col(column) == F.lit(school_id))


def drop_sentinels(df: DataFrame, column: str, bad: Iterable = (0, 999999)) -> DataFrame:
    """Drop NULL and sentinel school numbers."""
    return df.where(col(column).isNotNull() & ~col(column).isin(*bad))


def half_open(c: Column | str, lo, hi) -> Column:
    """Lo <= c < hi."""
    return (col(c) >= F.lit(lo).cast("date")) & (col(c) < F.lit(hi).cast("date"))


def any_flag(cols: Sequence[str]) -> Column:
    """1 when any of the 0/1 columns is 1."""
    return F.greatest(*[F.coalesce(col(c), F.lit(0)) for c in cols])


# ---- C03 ---------------------------------------------------------------------

def school_key_map(schools: DataFrame, keys: Sequence[str] = ("id", "dcid", "school_number"),
                   extra: Sequence[str] = (), dedupe: bool = True) -> DataFrame:
    """Long map ``school_key -> schoolNum, schoolName`` over any of the
    school's identifiers.  ``dedupe`` removes the double rows that appear when
    two identifiers of one school coincide (SURVEY 8.6); rows that differ in any
    column all stay."""
    keyed = schools.select(
        F.explode(F.array(*[col(k).cast("long") for k in keys])).alias("school_key"),
        col("school_number").cast("long").alias("schoolNum"),
        col("name").alias("schoolName"),
        *[col(e) for e in extra],
    )
    if dedupe:
        keyed = keyed.distinct()
    return keyed


# ---- C06 / J07 / J08 -----------------------------------------------------------

def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is small enough to be sent to every task.  Hand in stored frames: their count
    comes from the files' footers."""
    return df.limit(rows + 1).count() <= rows


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]],
                 lstart: str, lend: str, rstart: str, rend: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi key(s) + ``l.start <= r.end AND NVL(l.end, r.end) >= r.start``.

    ``right`` is calendar-like.  Up to ``broadcast_rows`` it is broadcast, so the big side is
    never shuffled for this join, and the equi key keeps it a hash join with a residual
    instead of a nested loop.  A larger one is joined by year: both sides go to the years
    that they touch, so a key with very many intervals is split over its years, and a
    pair counts in the first year that both touch."""
    cond = [left[a] == right[b] for a, b in keys]
    cond.append(left[lstart] <= right[rend])
    cond.append(F.coalesce(left[lend], right[rend]) >= right[rstart])
    if fits(right, broadcast_rows):
        return left.join(dimension(right), on=reduce(lambda a, b: a & b, cond))
    years = lambda a, b: (F.least(F.year(a), F.year(b)), F.greatest(F.year(a), F.year(b)))
    lo, hi = years(right[rstart], right[rend])
    ends = right.select(lo.alias("lo"), hi.alias("hi")).agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    first, last = ends.select("first").scalar(), ends.select("last").scalar()
    whole = right[rstart].isNotNull() & right[rend].isNotNull()
    r = right.where(whole).withColumn("_rlo", lo).withColumn("_ryear", F.explode(F.sequence(lo, hi)))
    # an open end reaches to the last year of all calendars
    lo, hi = F.year(left[lstart]), F.coalesce(F.year(left[lend]), F.greatest(F.year(left[lstart]), last))
    l = left.where(left[lstart].isNotNull()).withColumn("_llo", F.greatest(F.least(lo, hi), first)) \
        .withColumn("_lhi", F.least(F.greatest(lo, hi), last))
    l = l.where("_llo <= _lhi").withColumn("_lyear", F.explode(F.sequence("_llo", "_lhi")))
    cond += [F.col("_lyear") == F.col("_ryear"), F.col("_lyear") == F.greatest("_llo", "_rlo")]
    return l.join(r, on=reduce(lambda a, b: a & b, cond)).drop("_llo", "_lhi", "_lyear", "_rlo", "_ryear")


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, salt_by: Sequence[str],
                hot_rows: int = 10_000, salts: int = 64) -> DataFrame:
    """Inner join whose hot keys are spread: a key that more than ``hot_rows`` rows of ``left`` carry
    goes to ``salts`` tasks, and its rows of ``right`` to each of them.  ``salt_by`` are columns of
    ``left`` that differ between the rows of a key; the salt is their hash, so a task that is run again
    deals the same.  There are at most rows / ``hot_rows`` hot keys.  Without any this is a plain join."""
    hot = store(left.groupBy(F.col(left_key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
                .where((F.col("_n") > hot_rows) & F.col("_hot").isNotNull()).select("_hot"), "hot_keys")
    if hot.isEmpty():
        return left.join(right, left[left_key] == right[right_key])
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    l = left.join(hot, left[left_key] == hot["_hot"], "left").withColumn("_lsalt", F.when(F.col("_hot").isNotNull(), salt).otherwise(0)) \
        .drop("_hot")
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    r = right.join(hot, right[right_key] == hot["_hot"], "left").withColumn("_rsalt", F.explode(every)).drop("_hot")
    return l.join(r, (left[left_key] == right[right_key]) & (F.col("_lsalt") == F.col("_rsalt"))).drop("_lsalt", "_rsalt")


# ---- C08 / U01 ---------------------------------------------------------------

def union_tagged(frames: Sequence[tuple[DataFrame, str]], tag: str = "sourceTable") -> DataFrame:
    """UNION ALL with a provenance column."""
    return union_all([df.withColumn(tag, F.lit(t)) for df, t in frames])


# ---- C09 / W01–W03 / W05 / W07 -------------------------------------------------

def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key by ``order``.  Callers must give a
    total order (SURVEY 8.19) so every engine keeps the same row.  Spark plans
    this as a WindowGroupLimit (partial top-1 before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def sequence_in_group(keys: Sequence[str], order: Sequence[Column]) -> Column:
    """1, 2, ... within each group."""
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def count_in_group(keys: Sequence[str]) -> Column:
    """Rows sharing the key."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


# ---- A08 / A09 / A10 / C21 ------------------------------------------------------

def pivot_conditional_max(df: DataFrame, keys: Sequence[str], outputs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``MAX(CASE WHEN cond THEN val END)`` per output column."""
    return df.groupBy(*keys).agg(*[F.max(F.when(c, v)).alias(n) for n, (c, v) in outputs.items()])


def listagg_ordered(df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[Column],
                    sep: str = "; ", alias: str = "agg", max_chars: int | None = None) -> DataFrame:
    """``LISTAGG(value, sep) WITHIN GROUP (ORDER BY order)``.

    Built as ``array_sort`` of (order..., value) structs, so the ordering key
    may differ from the value and NULL values are skipped like LISTAGG.

    ``max_chars``: the caller keeps only the first ``max_chars`` characters of
    the trimmed list.  Every value after the first adds at least the separator's
    non-blank ';', so the first ``max_chars + 2`` values already fill that
    prefix exactly; the rest cannot change the output.  They are dropped with a
    per-key top-k (``WindowGroupLimit``: partial top-k before the shuffle), so
    no group ever collects more than ``max_chars + 2`` values into one task.
    """
    fields = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [value.alias("_v")]
    src = df
    if max_chars is not None:
        if not sep.strip():
            raise ValueError("max_chars needs a separator with a non-blank character")
        # NULL values rank last, so a group of only NULLs keeps one row (and yields NULL)
        w = Window.partitionBy(*keys).orderBy(value.isNull(), *order, value)
        src = src.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= max_chars + 2)
    agg = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(*fields))))
    joined = F.array_join(F.transform(agg, lambda s: s["_v"]), sep)
    # like LISTAGG, a group without any value gives NULL
    return src.groupBy(*keys).agg(F.when(F.size(agg) > 0, joined).alias(alias))


# ---- C24 / C25 / A05 / A07 / P19 ----------------------------------------------------

def net_balance(df: DataFrame, keys: Sequence[str], amount: str, precision=(10, 2),
                alias: str = "amount") -> DataFrame:
    """Decimal sum per key, rounded once, zero totals dropped.  Addends keep eight
    places as decimals: exact and associative, so partial aggregation is safe."""
    p, s = precision
    return (df.groupBy(*keys)
            .agg(F.sum(col(amount).cast("decimal(28,8)")).cast(f"decimal({p},{s})").alias(alias))
            .where(F.col(alias) != 0))
