"""Exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments; with mean m and deviation s of each segment of length l,
the inner product of two vectors is at most the sum over segments of
l * (m m' + s s') (the segment-wise form of Cauchy and Schwarz, and of the lower bound
on the distance).  Coarse segments are tried first, finer ones on what is left, and
the exact integer product is formed for the survivors only.

Vectors that are null or hold a null or non-finite component take no part, nor do rows
without id.  Shorter vectors count as padded with zeros.  Rows that share a query's id
are the query's own.  A query id that repeats is asked by each of its rows.  Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import kept, ship

SCALE = 1024
#: Candidates of a block, queries that meet it together, and queries that are sent to the tasks at a time.
BLOCK, QUERY_BLOCK, QUERIES_AT_ONCE = 2048, 512, 8192
SEGMENTS = (4, 16)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``v`` (array<bigint>): floor(1024 * x) of each component, as double."""
    bad = F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * float(SCALE)).cast("long")).alias("v")))


def _matrix(vectors: list) -> np.ndarray:
    m = np.zeros((len(vectors), max([1, *map(len, vectors)])), dtype="int64")
    for i, v in enumerate(vectors):
        m[i, :len(v)] = v
    return m


def _segments(m: np.ndarray, n: int, dims: int) -> tuple[np.ndarray, int]:
    """Means and deviations, side by side, of n segments of equal length (padded with zeros), and that length."""
    length = -(-dims // n)
    padded = np.zeros((m.shape[0], n * length))
    padded[:, :m.shape[1]] = m
    cut = padded.reshape(len(m), n, length)
    return np.hstack([cut.mean(axis=2), cut.std(axis=2)]), length


def _exact(q: np.ndarray, c: np.ndarray) -> list[int]:
    """Integer products of one query; doubles where every partial sum is exact in them."""
    n = min(len(q), c.shape[1])
    q, c = q[:n], c[:, :n]
    if float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, n) < 2**53:
        return (c.astype(float) @ q.astype(float)).astype("int64").tolist()
    return [int(x) for x in c.astype(object) @ q.astype(object)]


class Search:
    """The k best candidates so far of each query (number, id, vector), over blocks of candidates."""

    def __init__(self, numbers: list, ids: list, vectors: list, k: int):
        self.numbers, self.ids, self.q, self.k = numbers, np.array(ids, dtype="int64"), _matrix(vectors), k
        self.norms = np.linalg.norm(self.q.astype(float), axis=1)
        self.best: list[list[tuple[int, int]]] = [[] for _ in numbers]  # (-score, id), best first
        self.levels: dict[tuple[int, int], tuple[np.ndarray, int]] = {}

    def floor(self, i: int) -> float:
        return -self.best[i][-1][0] if len(self.best[i]) == self.k else -np.inf

    def _segments(self, n: int, dims: int) -> tuple[np.ndarray, int]:
        if (n, dims) not in self.levels:
            self.levels[n, dims] = _segments(self.q, n, dims)
        return self.levels[n, dims]

    def _try(self, i: int, ids: np.ndarray, c: np.ndarray) -> None:
        scored = [(-s, v) for s, v in zip(_exact(self.q[i], c), ids.tolist(), strict=True)]
        self.best[i] = sorted(self.best[i] + scored)[:self.k]

    def block(self, ids: np.ndarray, c: np.ndarray) -> None:
        """Coarse bounds say which candidates of the block can reach a query's floor; finer bounds are
        formed for these, exact products for what is left."""
        dims = max(self.q.shape[1], c.shape[1])
        c_norms = np.linalg.norm(c.astype(float), axis=1)
        sides = {n: _segments(c, n, dims) for n in SEGMENTS}
        mine, length = self._segments(SEGMENTS[0], dims)
        theirs = sides[SEGMENTS[0]][0].T * length
        for first in range(0, len(self.numbers), QUERY_BLOCK):
            coarse = mine[first:first + QUERY_BLOCK] @ theirs
            for i, bound in enumerate(coarse, start=first):
                slack = 1e-9 * self.norms[i] * c_norms + 1  # far above the rounding of a bound
                bound = np.where(ids == self.ids[i], -np.inf, bound + slack)
                if len(self.best[i]) < self.k:  # promising candidates give a floor that others must reach
                    few = np.argpartition(-bound, min(self.k, len(ids)) - 1)[:self.k]
                    few = few[bound[few] > -np.inf]
                    self._try(i, ids[few], c[few])
                    bound[few] = -np.inf
                # ties count: of equal scores the smaller id is better
                left = np.flatnonzero((bound >= self.floor(i)) & (bound > -np.inf))
                for n in SEGMENTS[1:]:
                    if not len(left):
                        break
                    side, size = sides[n]
                    fine = size * (side[left] @ self._segments(n, dims)[0][i]) + slack[left]
                    left = left[fine >= self.floor(i)]
                if len(left):
                    self._try(i, ids[left], c[left])

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        for number, own, best in zip(self.numbers, self.ids.tolist(), self.best, strict=True):
            for s, v in best:
                yield number, own, v, -s


def _search(shipped, k: int):
    """Of each task the k best candidates of each query; the floors hold from block to block."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shipped.value, k)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                search.block(part.column(0).to_numpy(), _matrix(part.column(1).to_pylist()))
        cols = list(zip(*search.rows(), strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=["q", "query_id", "vec_id", "score"])
    return run


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k highest scores over all rows
    but those of its own id, ties to the smaller id.

    The query set meets all rows in blocks: QUERIES_AT_ONCE queries are sent to all tasks at a time, and a
    task passes its candidates by them block by block.  A task returns at most k rows a query.
    """
    spark = df.sparkSession
    ship(spark)
    vectors = integer_vectors(df, id_col, vec_col)
    asked = kept(integer_vectors(queries, id_col, vec_col).withColumn("q", F.monotonically_increasing_id()))
    n = asked.count()
    turns = -(-n // QUERIES_AT_ONCE)
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id")
    for turn in range(turns):
        rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(turns)) == turn).orderBy("q").collect()
        shipped = spark.sparkContext.broadcast(([r.q for r in rows], [r.id for r in rows], [r.v for r in rows]))
        found = vectors.mapInArrow(_search(shipped, k), "q long, query_id long, vec_id long, score long")
        out = out.unionByName(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                              .select("query_id", "rank", "vec_id", "score"))
    return out
