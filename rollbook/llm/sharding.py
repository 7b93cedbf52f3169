"""Sharding by proportional stratified interleaving, rows of equal text together.

Rows are dealt in units: all rows of one text, or single rows where a text has more rows
than a shard and so cannot stay in one piece.  Units of each source are put in a seeded
random order, a unit's place within its source (counted in rows) becomes a fraction, all
units are sorted by that fraction, and the sorted list is cut into shards.  Every shard
so holds every source in the proportion of the whole table.  A cut goes round units, not
through them; what a shard then has above its due is given away from its smallest units,
so that row counts differ by one at most.  A unit is cut only where a shard's surplus or
another's room ends inside it: fewer than two units per shard.  DataFrame functions only.

A null text has size 8 (no bytes) and the checksum of no bytes, and goes with empty texts;
a null source is a source of its own; a text found in several sources belongs to the first
by name; rows that repeat are dealt like any others; an empty table gives no rows; a very
long text is hashed once and not moved; other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import hex_digits, kept, nullable_key, rank_in_group

FRACTION_BITS = 48


def _before(units: DataFrame, group: list[str], hexed: str, digits: int, name: str) -> DataFrame:
    """``units`` with the rows (sum of ``n``) of the units before each in its group, by ``hexed`` and unit.
    Like ``rank_in_group``: sums per cell of leading hex digits, then a window over each cell."""
    d = units.withColumn("_cell", F.substring(hexed, 1, digits))
    past = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (d.groupBy(*group, "_cell").agg(F.sum("n").alias("_n"))
             .withColumn("_past", F.coalesce(F.sum("_n").over(past), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*group, "_cell").orderBy(hexed, "u").rowsBetween(Window.unboundedPreceding, -1)
    return (d.join(cells, [*group, "_cell"])
            .withColumn(name, F.col("_past") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .drop("_cell", "_past"))


def _longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _shard_of(place: Column, ends: list[int]) -> Column:
    """The first shard whose running total ``ends`` lies above ``place``."""
    return F.size(F.filter(_longs(ends), lambda e: e <= place))


def interleave(docs: DataFrame, shards: int, seed: int = 11, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: ``id``, ``size``, ``crc``, ``shard`` and ``slot`` (gapless from
    0 in each shard, in seeded random order).  Row counts of shards differ by one at most.

    Memory: the largest sort holds one cell, (source, hash prefix) or a slice of the
    fraction; prefixes lengthen with the row count.  The driver sees numbers per shard
    only: row counts, and the texts that have more rows than a shard (fewer than shards).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    stored = kept(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.md5(F.encode(text, "UTF-8")).alias("t"),
        nullable_key(source_col).alias("g")))
    total = stored.count()
    digits = hex_digits(total)
    texts = kept(stored.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("g").alias("g")))
    split = [r.t for r in texts.filter(F.col("n") > total // shards).select("t").collect()]  # fewer than ``shards``
    x = F.md5(F.concat_ws("|", F.lit(seed), nullable_key("id"), "crc", "size"))
    alone = F.col("t").isin(split) if split else F.lit(False)
    rows = stored.withColumn("x", x).withColumn("u", F.when(alone, F.concat("t", F.lit("-"), "x")).otherwise(F.col("t")))
    units = texts.filter(~alone).select(F.col("t").alias("u"), "n", "g")
    if split:
        units = units.unionByName(rows.filter(alone).groupBy("u", "g").agg(F.count(F.lit(1)).alias("n"))
                                  .groupBy("u").agg(F.sum("n").alias("n"), F.min("g").alias("g")))

    units = _before(units.withColumn("o", F.md5(F.concat_ws("|", F.lit(seed), "u"))), ["g"], "o", digits, "at")
    sources = units.groupBy("g").agg(F.sum("n").alias("of"))
    fraction = (2 * F.col("at") + F.col("n")) / (2 * F.col("of"))
    hexed = F.lpad(F.hex(F.floor(fraction * float(2**FRACTION_BITS))), FRACTION_BITS // 4, "0")
    spread = units.join(sources, "g").select("u", "n", "o", hexed.alias("f"), F.lit(0).alias("one"))
    # a unit goes where its middle row falls
    first = kept(_before(spread, ["one"], "f", digits, "at").select(
        "u", "n", "o", F.expr(f"cast(((2 * at + n) * {shards}) div {2 * max(total, 1)} as int)").alias("shard")))
    return _numbered(_levelled(first, rows, shards, total, digits), digits)


def _levelled(units: DataFrame, rows: DataFrame, shards: int, total: int, digits: int) -> DataFrame:
    """``rows`` with their shard after each shard has given its surplus to those with room.

    A shard gives its smallest units first.  What all shards give forms one line, shard
    by shard, and the shards with room take from it in order.
    """
    have = {r.shard: r.n for r in units.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # one row per shard
    due = [(s + 1) * total // shards - s * total // shards for s in range(shards)]
    over = [max(0, have.get(s, 0) - due[s]) for s in range(shards)]
    room = list(accumulate(max(0, due[s] - have.get(s, 0)) for s in range(shards)))
    line = [0, *accumulate(over)][:shards]
    number = lambda values: F.element_at(_longs(values), F.col("shard") + 1)

    sizes = (units.groupBy("shard", "n").agg(F.sum("n").alias("rows"))
             .withColumn("smaller", F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("n").rowsBetween(
                 Window.unboundedPreceding, -1)), F.lit(0))).drop("rows"))
    # only units of sizes that are given away need a place among their like
    giving = units.join(sizes, ["shard", "n"]).filter(F.col("smaller") < number(over))
    ranked = (_before(giving, ["shard", "n"], "o", digits, "like")
              .withColumn("give", number(over) - F.col("smaller") - F.col("like")).filter("give > 0")
              .withColumn("start", number(line) + F.col("smaller") + F.col("like")))
    last = F.col("start") + F.least(F.col("give"), F.col("n")) - 1
    moved = kept(ranked.select("u", "n", "give", "start", F.col("shard").alias("home"),
                               _shard_of(F.col("start"), room).alias("to"),
                               ((F.col("give") < F.col("n")) | (_shard_of(F.col("start"), room) < _shard_of(last, room))).alias("cut")))
    # rows of the few units that are cut are numbered, all others follow their unit
    homes = kept(units.join(moved.select("u", "to", "cut"), "u", "left")
                 .select("u", F.coalesce("to", "shard").alias("shard"), F.coalesce("cut", F.lit(False)).alias("cut")))
    placed = rows.join(homes, "u")
    pieces = rank_in_group(placed.filter("cut").drop("shard"), ["u"], "x", ["id"], digits, "j", "of").join(
        moved.filter("cut").select("u", "home", "give", "start"), "u")
    shard = F.when(F.col("j") < F.col("give"), _shard_of(F.col("start") + F.col("j"), room)).otherwise(F.col("home"))
    columns = ["id", "size", "crc", "x"]
    return kept(placed.filter(~F.col("cut")).select(*columns, "shard").unionByName(
        pieces.select(*columns, shard.cast("int").alias("shard"))))


def _numbered(rows: DataFrame, digits: int) -> DataFrame:
    ranked = rank_in_group(rows, ["shard"], "x", ["id", "crc", "size"], digits, "slot", "of")
    return ranked.select("id", "size", "crc", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
