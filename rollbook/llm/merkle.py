"""Merkle manifest of a dataset by a nested-struct rollup.

Every row is a leaf.  Within a source leaves have a rank; its base-16 digits are grouped
away one after the other, from the lowest: a group of 16 becomes one struct that nests its
children and holds their digests as one string.  Three digits make a block of at most
4,096 leaves, which one more ``transform`` over the nested structs turns into proofs, and
an ``explode`` back into rows: inside a block no join and no second shuffle.  Blocks are
the leaves of the next rollup, with one narrow row each, and so on until every source has
one digest; the sources' digests are rolled up the same way.  What lies above a block
comes to it as one row per block, so no task ever holds more than a block, however many
rows a source has.

A run of fewer than 16 nodes (the last one) is hashed like a full one, a single node that
is left over by a longer level too; a source's only leaf is its digest.

Null ids come last in their source, null sources are one source and the first; rows that
tie on the id are ordered by their leaf, and rows that repeat are leaves of their own.
Texts of any length are hashed whole.  Other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import kept, nullable_key
from rollbook.operators.ordering import with_ordinal

FAN = 16
#: Digits that are grouped away within one block, and its leaves.
LEVELS = 3
BLOCK = FAN**LEVELS
HEX = 64
PATH = "array<struct<left string, right string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    """Digest of values in order: `-` for null, else byte count, colon, value."""
    text = [v.cast("string") for v in values]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def _up(count: Column | str) -> Column:
    """Nodes of the next level."""
    c = F.col(count) if isinstance(count, str) else count
    return F.shiftright(c + (FAN - 1), 4)


def _run(digit: str, nodes: str, *carry: str) -> tuple[Column, Column, Column]:
    """Of a group: its children in order, their digests as one string, and the digest of the node."""
    children = F.array_sort(F.collect_list(F.struct(digit, "hash", *carry)))
    cat = F.array_join(F.transform(children, lambda c: c["hash"]), "")
    return children, cat, F.when(F.first(nodes) > 1, F.sha2(cat, 256)).otherwise(cat)


def roll_up(nodes: DataFrame) -> DataFrame:
    """``g``, ``n`` (nodes of the group), ``pos``, ``hash``, ``load`` -> one row per block: ``g``, ``n``,
    ``block``, ``hash``, and ``cat``/``kids`` nested three levels deep.

    The rows are dealt out by block once; the groupings are finer or equal, so they need no further shuffle.
    """
    digit = lambda level: F.pmod(F.shiftright("pos", 4 * level), F.lit(FAN)).cast("int")
    t = (nodes.select("g", "n", F.shiftright("pos", 4 * LEVELS).alias("block"), digit(0).alias("d0"), digit(1).alias("d1"),
                      digit(2).alias("d2"), "hash", "load").repartition("g", "block")
         .withColumn("n1", _up("n")).withColumn("n2", _up("n1")))
    kids, cat, node = _run("d0", "n", "load")
    t = (t.groupBy("g", "n", "n1", "n2", "block", "d2", "d1").agg(kids.alias("kids"), cat.alias("cat"), node.alias("hash"))
         .withColumn("kids", F.transform("kids", lambda c: c["load"])))
    kids, cat, node = _run("d1", "n1", "cat", "kids")
    inner = lambda c: F.struct(c["cat"].alias("cat"), c["kids"].alias("kids"))
    t = (t.groupBy("g", "n", "n1", "n2", "block", "d2").agg(kids.alias("kids"), cat.alias("cat"), node.alias("hash"))
         .withColumn("kids", F.transform("kids", inner)))
    kids, cat, node = _run("d2", "n2", "cat", "kids")
    return (t.groupBy("g", "n", "n1", "n2", "block").agg(kids.alias("kids"), cat.alias("cat"), node.alias("hash"))
            .withColumn("kids", F.transform("kids", inner)))


def _sides(cat: Column, i: Column) -> tuple[Column, Column]:
    """Digests before and after the i-th of a run."""
    return F.substring(cat, F.lit(1), i * HEX), F.substring(cat, (i + 1) * HEX + 1, F.lit(FAN * HEX))


def unrolled(blocks: DataFrame, make) -> Column:
    """The nodes of a block in order, as an array: ``make(load, hash, position in block, sides)`` for
    each, with the three levels' (left, right, whether the level is hashed)."""
    def at(k2, i2, k1, i1, x, i0):
        sides = [(*_sides(k1["cat"], i0), F.col("n") > 1), (*_sides(k2["cat"], i1), F.col("n1") > 1),
                 (*_sides(F.col("cat"), i2), F.col("n2") > 1)]
        return make(x, F.substring(k1["cat"], i0 * HEX + 1, F.lit(HEX)), (i2 * FAN + i1) * FAN + i0, sides)

    of_run = lambda k2, i2: lambda k1, i1: F.transform(k1["kids"], lambda x, i0: at(k2, i2, k1, i1, x, i0))
    nested = F.transform("kids", lambda k2, i2: F.transform(k2["kids"], of_run(k2, i2)))
    return F.flatten(F.flatten(nested))


def climb(nodes: DataFrame) -> DataFrame:
    """``g``, ``n``, ``pos``, ``hash`` -> ``g``, ``pos``, ``top`` (the group's digest) and ``path`` (left and
    right siblings of each level from the node up)."""
    alone = nodes.filter("n = 1").select("g", "pos", F.col("hash").alias("top"), F.array().cast(PATH).alias("path"))
    many = nodes.filter("n > 1")
    if many.isEmpty():
        return alone
    blocks = kept(roll_up(many.withColumn("load", F.lit(True))))
    above = climb(blocks.select("g", _up("n2").alias("n"), F.col("block").alias("pos"), "hash"))

    def step(_, __, at, sides):
        path = F.array(*[F.when(hashed, F.struct(left.alias("left"), right.alias("right"))) for left, right, hashed in sides])
        return F.struct((F.col("block") * BLOCK + at).alias("pos"), F.filter(path, lambda p: p.isNotNull()).alias("path"))

    up = above.select("g", F.col("pos").alias("block"), "top", F.col("path").alias("more"))
    out = (blocks.join(up, ["g", "block"]).select("g", "top", "more", F.explode(unrolled(blocks, step)).alias("x"))
           .select("g", "x.pos", "top", F.concat("x.path", "more").alias("path")))
    return alone.unionByName(out)


def _folded(start: Column, sides) -> Column:
    for left, right, hashed in sides:
        start = F.when(hashed, digest(left, start, right)).otherwise(start)
    return start


def manifest(rows: DataFrame) -> DataFrame:
    """``id``, ``source``, ``leaf``, ``claim`` (the leaf of what a reader holds) -> ``id``, ``leaf``, ``subroot``,
    ``root``, ``proof`` (digest of all siblings from the leaf to the root) and ``folded`` (the root that
    the claim and the siblings give)."""
    narrow = kept(rows.select(nullable_key("source").alias("g"), "source", "id", "leaf", "claim"))
    order = [F.col("id").asc_nulls_last(), F.col("leaf").asc(), F.col("claim").asc()]
    ranked = with_ordinal(narrow.drop("source"), order, "pos", per=["g"], total="n").withColumn("pos", F.col("pos") - 1)
    blocks = kept(roll_up(ranked.select("g", "n", "pos", F.col("leaf").alias("hash"), F.struct("id", "claim").alias("load"))))
    paths = kept(climb(blocks.select("g", _up("n2").alias("n"), F.col("block").alias("pos"), "hash")))

    # the sources' digests, in order of source, are the leaves of the tree on top
    names = narrow.groupBy("g").agg(F.min("source").alias("source"))
    tops = kept(paths.filter("pos = 0").join(names, "g").select("g", "source", F.col("top").alias("hash")))
    one = with_ordinal(tops, [F.col("source").asc_nulls_first()], "pos", total="n").withColumn("pos", F.col("pos") - 1)
    one = kept(one)
    over = climb(one.select(F.lit("").alias("g"), "n", "pos", "hash")).select("pos", F.col("top").alias("root"), "path")
    over = kept(one.select("g", "pos").join(over, "pos").select("g", "root", F.col("path").alias("last")))

    above = (paths.join(over, "g").select("g", F.col("pos").alias("block"), F.col("top").alias("subroot"), "root",
                                          F.concat("path", "last").alias("path")))
    above = above.withColumn("siblings", F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""))

    def proof(load, own, _, sides):
        folded = F.aggregate(F.col("path"), _folded(load["claim"], sides), lambda acc, p: digest(p["left"], acc, p["right"]))
        siblings = [F.when(hashed, F.concat(left, right)).otherwise("") for left, right, hashed in sides]
        return F.struct(load["id"].alias("id"), own.alias("leaf"), digest(*siblings, F.col("siblings")).alias("proof"),
                        folded.alias("folded"))

    return (blocks.join(above, ["g", "block"]).select("subroot", "root", F.explode(unrolled(blocks, proof)).alias("x"))
            .select("x.id", "x.leaf", "subroot", "root", "x.proof", "x.folded"))
