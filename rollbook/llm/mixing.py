"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies, target / size
of the source.  The documents are put in order of size class and then of a seeded
hash; along that order the expected copies are summed up, one random offset per source
is added, and a document is emitted once for each integer that its step crosses.  The
size order stratifies the sample, so the words taken stay near the target; of a grid
of DRAWS seeded offsets a source uses the one that comes nearest to it.

Rows that repeat id, source and text are one unit and share their copies.  A null text
has no words, a null source is a source of its own and comes last, a null id is a
value like any other, a very long text is counted and hashed in one scan and moved only
by ``mixed_documents``, ties of class and hash go by id, text hash and size, an empty
table gives no rows.  All arithmetic on positions is in
integers, so a rerun gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import WORD, fresh, hex_digits, kept, nullable_key, rank_in_group

#: Expected copies are held in 2**-24ths: 3 copies times 10**10 documents stay far below 2**63.
UNIT_BITS = 24
UNIT = 2**UNIT_BITS
#: Candidate offsets of a source.
DRAWS = 64
#: Tables of sources, or of sources and size classes, are broadcast up to so many rows; beyond, the join shuffles.
MOST_BROADCAST = 100_000


def word_count(text: str | Column) -> Column:
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def _size_class(size: str) -> Column:
    """Exact below 32, then 32 classes to each doubling: a few hundred classes in all."""
    top = F.floor(F.log2(F.greatest(F.col(size), F.lit(1)).cast("double")))
    step = F.pow(F.lit(2.0), F.greatest(top - 5, F.lit(0)))
    return F.when(F.col(size) < 32, F.col(size)).otherwise(top * 64 + F.floor(F.col(size) / step)).cast("long")


def _small(stored: DataFrame) -> DataFrame:
    """A stored table, broadcast if its counted rows are few, so that a hot source's rows stay where they are."""
    return F.broadcast(stored) if stored.count() <= MOST_BROADCAST else stored


def targets(sizes: DataFrame, weights: tuple[float, ...], max_copies: int) -> DataFrame:
    """``source``, ``g``, ``source_size`` -> the same with ``target``.

    Targets share the sum of all sizes by weight; one that would pass ``max_copies``
    times its source's size stops there and the excess goes to the others by weight.
    In order of cap per weight the capped sources are a prefix, so one pass finds the
    common level.  One row per source: this is the only table that one task sorts.
    """
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(max_copies))
         .withColumn("ratio", F.col("cap") / F.col("w")))
    by_ratio = Window.partitionBy().orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    s = (s.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
                      / F.sum("w").over(later))
         .withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything)))
    return s.select("source", "g", "source_size",
                    F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = 3, seed: int = 5,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per distinct (id, source, text): ``id``, ``source``, ``h``, ``size``,
    ``source_size``, ``target``, ``repeats`` (input rows of the unit) and ``copies`` (how
    often each of them is taken, at most ``max_copies``)."""
    units = kept(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                             F.xxhash64(text_col).alias("h"), word_count(text_col).alias("size"))
                 .groupBy("id", "source", "h", "size").agg(F.count(F.lit(1)).alias("repeats")))
    n = units.count()
    sizes = (units.groupBy("source").agg(F.sum(F.col("size") * F.col("repeats")).alias("source_size"))
             .withColumn("g", nullable_key("source")))
    goal = kept(targets(sizes, weights, max_copies))

    d = (units.withColumn("g", nullable_key("source")).withColumn("c", _size_class("size"))
         .withColumn("x", F.md5(F.concat_ws("|", F.lit(seed), nullable_key("id"), "h"))))
    ranked = rank_in_group(d, ["g", "c"], "x", ["id", "h", "size"], hex_digits(n))
    # classes before this one, in the same source
    classes = d.groupBy("g", "c").count()
    steps = (classes.withColumn("before", F.coalesce(F.sum("count").over(
        Window.partitionBy("g").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("count").join(goal.drop("source"), "g")
        .withColumn("step", F.when(F.col("source_size") > 0,
                                   F.floor(F.col("target") / F.col("source_size") * float(UNIT))).otherwise(0).cast("long")))
    placed = kept(ranked.drop("group_n", "x").join(_small(kept(steps)), ["g", "c"])
                  .withColumn("at", (F.col("before") + F.col("rank0")) * F.col("step"))
                  .select("id", "source", "h", "size", "repeats", "g", "source_size", "target", "step", "at"))
    drawn = _small(kept(_offsets(placed, goal, seed)))
    over = "shiftright({} + offset, " + str(UNIT_BITS) + ")"
    return (placed.join(drawn, "g")
            .withColumn("copies", F.expr(f"{over.format('at + step')} - {over.format('at')}"))
            .select("id", "source", "h", "size", "source_size", "target", "repeats", "copies"))


def _offsets(placed: DataFrame, goal: DataFrame, seed: int) -> DataFrame:
    """``g`` -> ``offset``: one random offset per source, on a grid of DRAWS steps from a seeded
    start.  Where whole documents are coarse against the target, offsets differ in the
    words they take; the grid point that comes nearest is the one used.

    A unit gets its extra copy for a cyclic range of offsets.  It adds its words where the
    range begins and takes them off where it ends, so one sum per source and grid point
    gives the words of every draw at once.
    """
    start = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), "g")), 1, UNIT_BITS // 4), 16, 10).cast("long")
    cell = UNIT // DRAWS
    part = F.pmod(F.col("step"), F.lit(UNIT))
    low = F.pmod(-part - F.col("at") - start, F.lit(UNIT))
    words = F.col("size") * F.col("repeats")
    edge = lambda x: F.ceil(x / float(cell)).cast("int")
    changes = (placed.select("g", F.explode(F.array(
        F.struct(edge(low).alias("j"), words.alias("d")),
        F.struct(edge(low + part).alias("j"), (-words).alias("d")))).alias("e"))
        .groupBy("g", "e.j").agg(F.sum("e.d").alias("d")))
    per_source = changes.groupBy("g").agg(F.collect_list(F.struct("j", "d")).alias("changes"))  # at most 2 * DRAWS + 1
    upto = lambda j: F.aggregate(F.filter("changes", lambda e: e.j <= j), F.lit(0).cast("long"), lambda s, e: s + e.d)
    base = F.floor(F.col("step") / F.lit(UNIT)) * F.col("source_size")
    step = placed.groupBy("g").agg(F.max("step").alias("step"))
    miss = lambda j: F.abs(F.col("base") + upto(j) + upto(j + DRAWS) - F.col("target"))
    draws = F.transform(F.sequence(F.lit(0), F.lit(DRAWS - 1)), lambda j: F.struct(miss(j).alias("m"), j.alias("j")))
    return (per_source.join(step, "g").join(goal, "g").withColumn("base", base)
            .select("g", F.pmod(start + F.array_min(draws)["j"] * cell, F.lit(UNIT)).alias("offset")))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = 3, seed: int = 5,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns."""
    k, s, h, n, copy = fresh(docs, "k", "s", "h", "n", "copy")
    plan = (mix_sources(docs, weights, max_copies, seed, id_col, text_col, source_col)
            .filter("copies > 0").select(nullable_key("id").alias(k), nullable_key("source").alias(s),
                                         F.col("h").alias(h), F.col("copies").cast("int").alias(n)))
    keyed = (docs.withColumn(k, nullable_key(f"`{id_col}`")).withColumn(s, nullable_key(f"`{source_col}`"))
             .withColumn(h, F.xxhash64(f"`{text_col}`")))
    return (keyed.join(kept(plan), [k, s, h]).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
            .drop(k, s, h, n, copy))
