"""Exact deduplication by 128-bit content hash with a byte comparison inside groups.

DataFrame functions only.  Rules for odd input:

- a null text counts as empty; all texts that are empty after normalisation are equal;
- a null id is larger than any id; rows that repeat id and text share their decision in
  ``exact_groups``, and ``drop_exact_copies`` keeps one of them;
- an empty table gives an empty result; columns besides id and text are ignored by
  ``exact_groups`` and passed on untouched by ``drop_exact_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import BLANKS, fresh, kept, nullable_key


def normalised(text: str = "text") -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def _hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One narrow row per document; texts never leave the scan here."""
    norm = docs.select(F.col(id_col).alias("id"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_cp"),
                       normalised(text_col).alias("norm"))
    return norm.select("id", "n_cp", F.unhex(F.md5("norm")).alias("h"), F.unhex(F.sha2("norm", 256)).alias("sha"))


def _collided(docs: DataFrame, text_col: str, repeated: DataFrame) -> DataFrame:
    """Hashes whose group holds different bytes, found by comparing the texts themselves.

    Only texts whose hash repeats are grouped, by hash and whole text.  Copies fold
    into one row in the map task, so a group of any size arrives as few rows.
    """
    texts = docs.select(normalised(text_col).alias("norm")).withColumn("h", F.unhex(F.md5("norm")))
    # the second key spreads what does not fold: the texts are hashed once more for the deal
    same = (texts.join(repeated.select("h"), "h", "left_semi")
            .groupBy("norm").agg(F.first("h").alias("h")))
    return same.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``n_cp``, ``h``, ``sha``, ``keep_id``, ``group_size``
    and ``top`` (rows of the group that tie for staying; more than one only when rows
    repeat an id).  Of equal texts the row with the most code points stays, then the
    smallest id.
    """
    rows = kept(_hashes(docs, id_col, text_col))
    # two levels: repeated ids fold first, which also counts the ties for the first place
    order = F.struct(F.col("n_cp").alias("a"), F.col("id").isNotNull().alias("b"), (-F.col("id")).alias("c"),
                     F.col("n").alias("n"))
    level = rows.groupBy("h", "id", "n_cp").agg(F.count(F.lit(1)).alias("n"))
    groups = kept(level.groupBy("h").agg(F.sum("n").alias("group_size"), F.max(order).alias("top")))
    repeated = groups.filter("group_size > 1")
    odd = kept(_collided(docs, text_col, repeated))

    # both sides are stored tables: AQE can split a hash that holds a large share of the rows
    plain = (rows.join(groups, "h")
             .select("id", "n_cp", "h", "sha", (-F.col("top.c")).alias("keep_id"), "group_size",
                     F.col("top.n").alias("top")))
    if odd.isEmpty():
        return plain
    # a collision of the 128-bit hash: those groups are told apart by their second, 256-bit hash,
    # and this small remainder of rows by the texts' own bytes
    return plain.join(odd, "h", "left_anti").unionByName(_split(docs, id_col, text_col, odd))


def _split(docs: DataFrame, id_col: str, text_col: str, odd: DataFrame) -> DataFrame:
    """Groups of the colliding hashes, keyed by whole normalised text."""
    d = (docs.select(F.col(id_col).alias("id"), F.char_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_cp"),
                     normalised(text_col).alias("norm"))
         .withColumn("h", F.unhex(F.md5("norm"))).join(odd, "h", "left_semi"))
    order = F.struct(F.col("n_cp").alias("a"), F.col("id").isNotNull().alias("b"), (-F.col("id")).alias("c"),
                     F.col("n").alias("n"))
    g = (d.groupBy("h", "norm", "id", "n_cp").agg(F.count(F.lit(1)).alias("n"))
         .groupBy("h", "norm").agg(F.sum("n").alias("group_size"), F.max(order).alias("top")))
    return (d.join(g, ["h", "norm"])
            .select("id", "n_cp", "h", F.unhex(F.sha2("norm", 256)).alias("sha"), (-F.col("top.c")).alias("keep_id"),
                    "group_size", F.col("top.n").alias("top")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    decided = kept(exact_groups(docs, id_col, text_col))
    k, h = fresh(docs, "k", "h")
    # a row is known by its id and hash, so rows that repeat an id with another text are kept apart
    key = [nullable_key("id").alias(k), F.col("h").alias(h)]
    gone = decided.filter(~F.col("id").eqNullSafe(F.col("keep_id"))).select(*key).distinct()
    keyed = docs.withColumn(k, nullable_key(f"`{id_col}`")).withColumn(h, F.unhex(F.md5(normalised(f"`{text_col}`"))))
    out = keyed.join(gone, [k, h], "left_anti")
    twice = kept(decided.filter((F.col("top") > 1) & F.col("id").eqNullSafe(F.col("keep_id"))).select(*key).distinct())
    if not twice.isEmpty():
        out = (out.join(twice, [k, h], "left_anti")
               .unionByName(out.join(twice, [k, h], "left_semi").dropDuplicates([k, h])))
    return out.drop(k, h)
