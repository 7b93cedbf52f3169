"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of like size share a block.  A block has ROWS_PER_KEY rows of bits for each key of its
fullest document, one bit a document; a document sets HASHES rows for each of its keys.
Keys are a term, and the term once more for each of LEVELS that its count reaches.  The AND of
a key's rows is a bitmap that can hold documents too many, never one too few.

A search never looks at texts first.  A term's score grows with its count, so the bitmaps of
its levels, weighted with the term's weight, add up over the query to an upper bound of
each document's score:

1. the best bounds of each query are rescored exactly, and the k-th of these scores is a
   floor for the k-th best of all;
2. every document whose bound reaches the floor is rescored exactly, whatever their number.

The index holds every document and knows no query.  Document frequencies and lengths are
counted over all documents.  Queries are asked in blocks of QUERIES_AT_ONCE.  Terms are
compared by their bytes when scores are formed, and by 64-bit hashes in bitmaps and
document frequencies.

Null and empty texts have no terms and are found by nothing; rows that repeat are documents of
their own, and rank one after the other; null ids come last among equal scores.  Texts
of any length are read whole.  Items are the distinct (id, text) rows of the queries; an item
without terms finds nothing.  Other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.llm.common import kept, ship, written
from rollbook.llm.hashing import mixed, odd, run_hashes

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Counts of a term in a document from which a further key is set.
LEVELS = (1, 2, 4)
HASHES = 4
#: Rows of a block for each key of its fullest document: about a fifth of its bits are set.
ROWS_PER_KEY = 18
#: Documents, and cells (documents times rows), of a block at most; a document larger than that is a block of its own.
BLOCK_DOCS, BLOCK_CELLS = 2048, 1 << 26
#: A block's fullest document has at most so many times the keys of its emptiest.
SPREAD = 1.3
#: Keys that a task gathers before it cuts blocks, and different terms before it writes counts.
GATHERED, COUNTED = 2_000_000, 2_000_000
QUERIES_AT_ONCE = 4096
#: Best bounds of a query that make its floor.
FIRST = 30
#: Keys of documents to rescore that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
INDEX = ("ids array<long>, hashes array<long>, sizes array<long>, most array<int>, width long, slices binary, "
         "terms array<long>, counts array<long>")

_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_LEVEL = np.array([odd(f"level {i}") for i in LEVELS], dtype=np.uint64)


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def length_norm(n: int, documents: int, total: int) -> int:
    """100 - 75 + 75 * n / mean length, in whole numbers."""
    return 25 + 75 * n * documents // total


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def part(tf: int, m: int) -> int:
    """Score of a term that occurs tf times, per unit of weight."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def rows_of(keys: np.ndarray, width: int) -> np.ndarray:
    """(HASHES, n) rows of keys in a block of this many rows."""
    x = mixed(keys)
    a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([(a + np.uint64(j) * b) % np.uint64(width) for j in range(HASHES)]).astype(np.int64)


# ---- index ---------------------------------------------------------------------------


def _block(docs: list[tuple]) -> dict:
    """Documents (id, hash, size, most, keys) as one row of the index."""
    width = max(64, ROWS_PER_KEY * len(docs[-1][4]))
    padded = -(-len(docs) // 8) * 8
    bits = np.zeros((width, padded), dtype=bool)
    for i, d in enumerate(docs):
        bits[rows_of(d[4], width).ravel(), i] = True
    ids, hashes, sizes, most, _ = zip(*docs, strict=True)
    return {"ids": list(ids), "hashes": list(hashes), "sizes": list(sizes), "most": list(most), "width": width,
            "slices": np.packbits(bits, axis=1).tobytes()}


def _blocks(docs: list[tuple]) -> Iterator[dict]:
    docs.sort(key=lambda d: len(d[4]))
    first = 0
    for i in range(1, len(docs) + 1):
        full = i == len(docs) or (i - first == BLOCK_DOCS or len(docs[i][4]) > SPREAD * len(docs[first][4]) + 16
                                  or (i - first + 1) * ROWS_PER_KEY * len(docs[i][4]) > BLOCK_CELLS)
        if full:
            yield _block(docs[first:i])
            first = i


def _folded(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h, at = np.unique(np.concatenate(hashes), return_inverse=True)
    return h, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                        ("most", pa.list_(pa.int32())), ("width", pa.int64()), ("slices", pa.binary()),
                        ("terms", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
    row = lambda r: pa.RecordBatch.from_pylist([r], schema=schema)
    docs, gathered = [], 0
    terms, counts, seen = [], [], 0
    for batch in batches:
        ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, h, words in zip(ids, hashes, run_hashes(batch.column(2).to_pylist(), _INSIDE), strict=True):
            if not len(words):
                continue
            term, tf = np.unique(words, return_counts=True)
            keys = np.concatenate([term[tf >= least] + _LEVEL[j] for j, least in enumerate(LEVELS)])
            docs.append((i, h, len(words), int(tf.max()), keys))
            gathered += len(keys)
            terms.append(term)
            counts.append(np.ones(len(term), dtype=np.int64))
            seen += len(term)
            if gathered >= GATHERED:
                yield from map(row, _blocks(docs))
                docs, gathered = [], 0
            if seen >= COUNTED:
                t, c = _folded(terms, counts)
                terms, counts, seen = [t], [c], len(t)
                if seen >= COUNTED // 2:
                    yield row({"terms": t.view(np.int64).tolist(), "counts": c.tolist()})
                    terms, counts, seen = [], [], 0
    if docs:
        yield from map(row, _blocks(docs))
    if terms:
        t, c = _folded(terms, counts)
        yield row({"terms": t.view(np.int64).tolist(), "counts": c.tolist()})


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of all documents: rows of blocks, and rows of term counts (partial document frequencies)."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return written(source.mapInArrow(_index, INDEX), "bitsliced_index")


# ---- queries -------------------------------------------------------------------------


@dataclass
class Queries:
    """A block of items: their terms with repeats, and the weights of all different terms."""

    items: list
    terms: list[bytes]
    hashes: np.ndarray
    members: list[tuple[np.ndarray, np.ndarray]]  # of each item: places of its terms, and how often it has them
    weights: np.ndarray | None = None
    documents: int = 0
    total: int = 0

    @staticmethod
    def of(rows: list[tuple]) -> Queries:
        bags = [Counter(terms_of(text)) for _, text in rows]
        terms = sorted(set().union(*bags))
        place = {t: j for j, t in enumerate(terms)}
        members = [(np.array([place[t] for t in b], dtype=int), np.array(list(b.values()), dtype=np.int64)) for b in bags]
        # one text of all terms: they hold no separators
        hashes = next(run_hashes([b" ".join(terms).decode("utf-8", "surrogatepass")], _INSIDE), None) if terms else None
        return Queries([i for i, _ in rows], terms, np.zeros(0, np.uint64) if hashes is None else hashes, members)


def _frequencies(index: DataFrame, q: Queries) -> dict[int, int]:
    """Document frequencies of the block's terms, by hash; at most as many rows as the block has terms."""
    asked = np.sort(q.hashes.view(np.int64))

    def some(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, c = (x.values.to_numpy(zero_copy_only=False) for x in batch.columns)
            at = np.isin(t, asked)
            yield pa.RecordBatch.from_arrays([pa.array(t[at]), pa.array(c[at])], names=["t", "c"])

    rows = (index.filter(F.col("terms").isNotNull()).select("terms", "counts").mapInArrow(some, "t long, c long")
            .groupBy("t").agg(F.sum("c").alias("c")))
    return {r.t: r.c for r in rows.collect()}


def _bounds(q: Queries, r: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(item, upper bounds of the block's documents) for each item that may have a hit."""
    n = len(r["ids"])
    slices = np.frombuffer(r["slices"], dtype=np.uint8).reshape(r["width"], -1)
    m = np.array([length_norm(s, q.documents, q.total) for s in r["sizes"]], dtype=float)
    most = np.array(r["most"], dtype=float)
    tops = [np.minimum(x - 1, most) for x in (*LEVELS[1:], np.inf)]
    reach = [1e9 * t / (1000 * t + 8 * m) for t in tops]
    gain = [reach[0], *[b - a for a, b in zip(reach, reach[1:], strict=False)]]
    for first in range(0, len(q.items), 256):
        some = range(first, min(first + 256, len(q.items)))
        used = np.unique(np.concatenate([q.members[j][0] for j in some]))
        if not len(used):
            continue
        local = np.zeros(len(q.terms), dtype=int)
        local[used] = np.arange(len(used))
        present, maps = None, []
        for level in _LEVEL:
            rows = rows_of(q.hashes[used] + level, r["width"])
            bitmap = slices[rows[0]]
            for x in rows[1:]:
                bitmap &= slices[x]
            present = bitmap if present is None else present & bitmap
            maps.append(present)
        live = maps[0].any(axis=1)
        for j in some:
            at, often = q.members[j]
            on = live[local[at]]
            if not on.any():
                continue
            at, w = local[at[on]], (q.weights[at[on]] * often[on]).astype(float)
            total = np.zeros(n)
            for bitmap, more in zip(maps, gain, strict=True):
                total += w @ np.unpackbits(bitmap[at], axis=1, count=n) * more
            yield j, total * (1 + 1e-9)


CANDIDATES = "q int, bound double, id long, h long"


def _candidates(q, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=["q", "bound", "id", "h"])


def _best_bounds(shipped):
    """Of each task and item the FIRST best bounds."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shipped.value
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                for j, bound in _bounds(q, r):
                    have = best.get(j, [])
                    least = have[-1][1] if len(have) == FIRST else 0.0
                    top = np.argsort(-bound, kind="stable")[:FIRST]
                    new = [(j, float(bound[i]), r["ids"][i], r["hashes"][i]) for i in top if bound[i] > least]
                    if new:
                        best[j] = sorted(have + new, key=lambda x: -x[1])[:FIRST]
        yield _candidates(q, [x for rows in best.values() for x in rows])
    return run


def _reaching(shipped, floors):
    """Every document whose bound reaches its item's floor."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, floor = shipped.value, floors.value
        for batch in batches:
            for r in batch.to_pylist():
                rows = []
                for j, bound in _bounds(q, r):
                    for i in np.flatnonzero(bound >= max(1, floor.get(j, 1))):
                        rows.append((j, float(bound[i]), r["ids"][i], r["hashes"][i]))
                yield _candidates(q, rows)
    return run


def _rescored(shipped):
    """(q, id, score) of documents (id, text, items) by the terms themselves."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shipped.value
        place = {t: j for j, t in enumerate(q.terms)}
        for batch in batches:
            items, ids, scores = [], [], []
            for i, text, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = terms_of(text)
                m = length_norm(len(words), q.documents, q.total)
                value = {place[t]: int(q.weights[place[t]]) * part(tf, m) for t, tf in Counter(words).items() if t in place}
                for j in asked:
                    at, often = q.members[j]
                    score = sum(value.get(a, 0) * o for a, o in zip(at.tolist(), often.tolist(), strict=True))
                    if score > 0:
                        items.append(j)
                        ids.append(i)
                        scores.append(score)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                                             names=["q", "id", "score"])
    return run


def _exact(found: DataFrame, source: DataFrame, shipped) -> DataFrame:
    """Exact scores of the documents in ``found`` (q, id, h); a document is read once for all its items."""
    units = kept(found.groupBy("id", "h").agg(F.collect_set("q").alias("items"))
                 .select(F.col("id").alias("_id"), F.col("h").alias("_h"), "items"))
    small = F.broadcast(units) if units.count() <= BROADCAST_KEYS else units
    rows = source.join(small, source["id"].eqNullSafe(F.col("_id")) & (source["h"] == F.col("_h")))
    return kept(rows.select("id", "text", "items").mapInArrow(_rescored(shipped), "q int, id long, score long"))


def _top(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _ask(spark: SparkSession, index: DataFrame, source: DataFrame, q: Queries, k: int) -> DataFrame:
    """``q``, ``rank``, ``id``, ``score`` for one block of items."""
    df = _frequencies(index, q)
    q.weights = np.array([weight(df.get(int(h), 0), q.documents) for h in q.hashes.view(np.int64)], dtype=np.int64)
    shipped = spark.sparkContext.broadcast(q)
    blocks = index.filter(F.col("width").isNotNull()).select("ids", "hashes", "sizes", "most", "width", "slices")
    best = blocks.mapInArrow(_best_bounds(shipped), CANDIDATES)
    w = Window.partitionBy("q").orderBy(F.col("bound").desc(), "id", "h")
    first = best.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= FIRST)
    # at most k scores an item, of the block's items
    floor = _top(_exact(first, source, shipped), k).groupBy("q").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = spark.sparkContext.broadcast({r.q: r.floor for r in floor.filter(F.col("n") == k).collect()})
    return _top(_exact(blocks.mapInArrow(_reaching(shipped, floors), CANDIDATES), source, shipped), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", index: DataFrame | None = None) -> DataFrame:
    """``item``, ``rank`` (from 1), ``id``, ``score``: the k documents of highest score above 0 for each item.
    ``index`` is one of ``build_index`` for the same documents."""
    spark = docs.sparkSession
    ship(spark)
    index = build_index(docs, id_col, text_col) if index is None else index
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    sums = index.filter(F.col("width").isNotNull()).agg(
        F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total")).first()
    asked = kept(items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).distinct())
    turns = -(-asked.count() // QUERIES_AT_ONCE) if sums.n else 0
    out = spark.createDataFrame([], "item long, rank int, id long, score long")
    for turn in range(turns):
        mine = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(turns)) == turn).orderBy("item", "text")
        q = Queries.of([(r.item, r.text) for r in mine.collect()])
        if not q.terms:
            continue
        q.documents, q.total = sums.n, sums.total
        names = spark.createDataFrame(list(enumerate(q.items)), "q int, item long")
        out = out.unionByName(_ask(spark, index, source, q, k).join(F.broadcast(names), "q").select("item", "rank", "id", "score"))
    return out
