"""Near-duplicate documents by MinHash bands, odd sketches and full shingle sets.

1. One pass over the texts gives each document its distinct word shingles, SAMPLES
   MinHash values of them, BANDS band keys, and an odd sketch: the samples folded into a
   parity bitmap, in which the ones of the XOR of two bitmaps estimate how many samples
   differ (precisely where few do).
2. Documents with the same set are one node.  Nodes that share a band key meet in a
   bucket.  A small bucket gives all its pairs; a large one gives the pairs of a few hubs
   with all members, again and again until all its members are known to be connected or
   each pair across components has been tried.  No bucket is collected, and no pair
   inside a component is tried.
3. Pairs pass the size ratio and the sketch first; what is left is confirmed on the full
   sets.  Confirmed links alone make the components.  Members of large buckets that the first
   hubs leave open also pass an exact bound of the shingles that two sets can share, so a
   group of texts just below the threshold does not send nearly all its pairs to the full sets.

The chance that a pair at similarity 0.8 shares no band is (1 - 0.8**4)**32 < 1e-7.

Texts without words, and null texts, have an empty set and stand alone.  A null id is no
component's smallest id unless all its ids are null.  Rows that repeat are members of the
same node.  Other columns are ignored by ``near_groups`` and passed on by
``drop_near_copies``.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import discard, fresh, kept, nullable_key, ship, slices, stored_bytes, written
from rollbook.llm.hashing import BASE, mixed, odd, run_hashes

#: MinHash samples, bands (a power of two), samples in a band, and bits of the sketch of all samples.
SAMPLES, BANDS, ROWS, BITS = 128, 32, 4, 512
#: Buckets of up to so many nodes give all their pairs.
SMALL = 8
#: Up to so many nodes of a large bucket outside its largest component all become hubs; of more, DRAWN
#: do.  The number grows by GROWTH each turn: the first turn joins what a few hubs can join, and the
#: nodes that really stand alone are then tried together, not carried from turn to turn.
FEW, DRAWN, GROWTH = 96, 16, 4
#: Nodes whose texts' hashes are broadcast at most, to leave the other texts out before a shuffle.
BROADCAST_NODES = 4_000_000
#: Size on disk up to which a stored table of a turn is broadcast.  Each row has a hash of eight bytes or more, which
#: does not compress, so such a table has some 130,000 rows at most.
BROADCAST_BYTES = 1 << 20
#: Hubs of the first turn, by so many hashes of the node.
FIRST_HUBS = 8
LONGS = BITS // 64
#: Cells that the shingles of a node in an open bucket are counted in.
CELLS = 2048
SIGNATURE = "id long, th long, n long, node binary, bands array<long>, sketch array<long>"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLY = np.array([odd(f"multiply {i}") & 0xFFFFFFFF for i in range(SAMPLES)], dtype=np.uint32)[:, None]
_ADD = np.array([odd(f"add {i}") & 0xFFFFFFFF for i in range(SAMPLES)], dtype=np.uint32)[:, None]
_PLACE = np.array([odd(f"place {i}") for i in range(SAMPLES)], dtype=np.uint64)


def _all_words(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text."""
    return run_hashes(texts, ~_BLANK)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n-word shingles; of the whole sequence if it is shorter."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    n = min(n, len(words))
    h = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        h = mixed(h * np.uint64(BASE) + words[i:len(words) - n + 1 + i])
    return np.unique(h)


def packed(s: np.ndarray) -> bytes:
    """A sorted set as the highest six bytes of each hash: what pairs are confirmed by, three quarters of
    its size.  That two of n shingles agree in them has a chance near n**2 / 2**49."""
    return s.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(v: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(v.as_buffer(), dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8").astype(np.uint64, copy=False)


def min_hashes(s: np.ndarray) -> np.ndarray:
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for a in range(0, len(x), 2048):
        np.minimum(low, (x[None, a:a + 2048] * _MULTIPLY + _ADD).min(axis=1), out=low)
    return low


def band_keys(m: np.ndarray) -> np.ndarray:
    """A key for each band; its lowest bits are the band's number."""
    h = band = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        h = mixed((h + np.uint64(1)) * np.uint64(BASE) + m[r:BANDS * ROWS:ROWS])
    return (h & ~np.uint64(BANDS - 1) | band).view(np.int64)


def odd_sketch(m: np.ndarray) -> np.ndarray:
    bits = mixed(m * _PLACE) % np.uint64(BITS)
    parity = (np.bincount(bits.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def sketch_cut(similarity: float, sigmas: float = 4.5) -> int:
    """Ones in the XOR that a pair of at least this similarity stays below, but for ``sigmas``
    standard deviations in each of its two sources of noise."""
    differ = SAMPLES * (1 - similarity) + sigmas * math.sqrt(SAMPLES * similarity * (1 - similarity))
    ones = BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * differ))
    return math.ceil(ones + sigmas * math.sqrt(BITS) / 4)  # the bits' own noise is about a quarter of the root


def _signatures(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            for first, texts in slices(batch.column(1), rows=2048):
                size, node, bands, sketch = [], [], [], []
                for words in _all_words(texts):
                    s = shingles(words, n)
                    size.append(len(s))
                    if len(s):
                        m = min_hashes(s)
                        node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                        bands.append(band_keys(m))
                        sketch.append(odd_sketch(m))
                    else:
                        node.append(None)
                        bands.append(None)
                        sketch.append(None)
                some = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), pa.array(size, pa.int64()), pa.array(node, pa.binary()),
                     pa.array(bands, longs), pa.array(sketch, longs)], names=["id", "th", "n", "node", "bands", "sketch"])
    return run


def _sets(n: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1), rows=2048):
                sets = [packed(shingles(w, n)) for w in _all_words(texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(sets, pa.binary())],
                                                 names=["node", "shingles"])
    return run


def _exploded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, shingle) rows of sets."""
    for batch in batches:
        for node, s in zip(batch.column(0), batch.column(1), strict=True):
            values = unpacked(s).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([node.as_py()] * len(values), pa.binary()), pa.array(values)],
                                             names=["node", "shingle"])


def _cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, cells, over) rows of sets: bitmaps of the cells with one and with two shingles or
    more, one after the other, and how many shingles lie in cells beyond their second."""
    for batch in batches:
        cells, over = [], []
        for v in batch.column(1):
            s = unpacked(v)
            count = np.bincount((s % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
            cells.append(np.packbits(np.concatenate([count >= 1, count >= 2])).view(np.int64))
            over.append(int(np.maximum(count - 2, 0).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.list_(pa.int64())), pa.array(over, pa.int64())],
                                         names=["node", "cells", "over"])


def _shared_at_most(a: Column, b: Column) -> Column:
    """What two sets can share: in each cell no more than the smaller of their counts."""
    ones = F.aggregate(F.zip_with(a["cells"], b["cells"], lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda t, x: t + x)
    return ones + F.least(a["over"], b["over"])


def _shared_sizes(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """``node``, ``alone``: how many of a node's shingles no other of ``nodes`` has.

    No link among these nodes can rest on such a shingle, so two nodes share at most what
    is left of the smaller: a bound that keeps a text with many words of its own from being
    compared with every member of a large group.
    """
    rows = sets.join(nodes, "node", "left_semi").select("node", "shingles").mapInArrow(_exploded, "node binary, shingle long")
    single = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).filter("c = 1"))
    return single.groupBy("node").agg(F.count(F.lit(1)).alias("alone"))


def _confirm(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                x, y = unpacked(a), unpacked(b)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(linked, pa.bool_()))
    return run


def components(edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """``node``, ``comp``: the smallest node that each node of ``edges`` (a, b) reaches.

    Each turn takes the smallest label among the neighbours and then the label's own
    label, so the number of turns grows with the logarithm of a component's diameter.
    All joins read stored tables, so AQE can split a node with very many links.
    """
    both = kept(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = kept(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                  .select("node", F.least("node", "m").alias("comp")))
    while True:
        near = (both.join(_near_at_hand(labels, labels.select(F.col("node").alias("b"), "comp")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        step = kept(near.join(_near_at_hand(labels, labels.select("node", "comp")), "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp")))
        up = step.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        new = kept(step.join(_near_at_hand(step, up), "comp").select("node", "old", F.col("top").alias("comp")))
        discard(labels, step)
        labels = new
        if new.filter(F.col("old") != F.col("comp")).isEmpty():
            discard(both)
            return labels


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` after more links: only the components that these join are labelled anew."""
    if links.isEmpty():
        return comp
    of = lambda x: _near_at_hand(comp, comp.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}")))
    ends = kept(links.join(of("a"), "a", "left").join(of("b"), "b", "left")
                .select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    top = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    every = kept(comp.select("node", "comp").unionByName(ends.select(F.col("a").alias("node"), F.col("ca").alias("comp")))
                 .unionByName(ends.select(F.col("b").alias("node"), F.col("cb").alias("comp"))).distinct())
    new = top.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    out = kept(every.join(_near_at_hand(top, new), "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")))
    discard(comp, ends, top, every)
    return out


def _near_at_hand(stored: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """``part`` of a stored table (or all of it), broadcast if the table is small: most tables of a turn
    are, and their joins then need no shuffle of either side."""
    part = stored if part is None else part
    return F.broadcast(part) if stored_bytes(stored) <= BROADCAST_BYTES else part


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _differ(a: Column, b: Column) -> Column:
    """Ones in the XOR of two sketches."""
    total = F.lit(0)
    for i in range(LONGS):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


class _Links:
    """Forms pairs of nodes that share a bucket, and keeps the links among them."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, percent: int):
        self.nodes, self.sets, self.percent = nodes, sets, percent
        self.cut = sketch_cut(percent / 100)

    def bounds(self) -> list[str]:
        """The columns of the bounds that hold among members of large buckets."""
        return [c for c in ("most", "cells", "over") if c in self.nodes.columns]

    def side(self, members: DataFrame, x: str, *bounds: str) -> DataFrame:
        """Members with what a pair is judged by."""
        info = self.nodes.select("node", F.struct("n", "sketch", "bands", *bounds).alias(f"info_{x}"))
        return members.join(_near_at_hand(self.nodes, info), "node").withColumnRenamed("node", x)

    def can_link(self, a: Column, b: Column, both: Column) -> Column:
        """Whether sets that share ``both`` shingles are a link."""
        return both * 100 >= (a["n"] + b["n"] - both) * self.percent

    def near(self, x: str, y: str, *bounds: str) -> Column:
        """Whether a pair can be a link by size (or by what it can share at most) and sketch, and
        ``band`` is the first that it shares."""
        a, b = F.col(f"info_{x}"), F.col(f"info_{y}")
        first = F.when(a["bands"][0] == b["bands"][0], 1)
        for i in range(1, BANDS):
            first = first.when(a["bands"][i] == b["bands"][i], i + 1)
        most = "most" if "most" in bounds else "n"
        out = (self.can_link(a, b, F.least(a[most], b[most]))
               & (_differ(a["sketch"], b["sketch"]) <= self.cut) & (first == F.col("band")))
        return out & self.can_link(a, b, _shared_at_most(a, b)) if "cells" in bounds else out

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        stored = kept(pairs)
        small = stored_bytes(stored) <= BROADCAST_BYTES

        def own(x: str) -> DataFrame:
            # where few pairs are left, the other sets stay out of the shuffle
            nodes = stored.select(F.col(x).alias("node"))
            sets = self.sets.join(F.broadcast(nodes) if small else nodes.distinct(), "node", "left_semi")
            return sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"))

        out = kept(stored.join(own("a"), "a").join(own("b"), "b").select("a", "b", "sa", "sb")
                   .mapInArrow(_confirm(self.percent), "a binary, b binary"))
        discard(stored)
        return out

    def of_small(self, members: DataFrame) -> DataFrame:
        m = self.side(members.select("key", "band", "node"), "a")
        other = m.select("key", F.col("a").alias("b"), F.col("info_a").alias("info_b"))
        return m.join(other, "key").filter((F.col("a") < F.col("b")) & self.near("a", "b")).select("a", "b")

    def of_hubs(self, members: DataFrame, hubs: DataFrame) -> DataFrame:
        """``members``: key, band, node, comp; ``hubs``: key, node, comp."""
        bounds = self.bounds()
        m = self.side(members.select("key", "band", "node", "comp"), "a", *bounds)
        h = self.side(hubs.select("key", "node", F.col("comp").alias("hub_comp")), "b", *bounds)
        if stored_bytes(hubs) <= BROADCAST_BYTES // 4:  # their rows grow by what pairs are judged by
            h = F.broadcast(h)
        return (m.join(h, "key").filter((F.col("comp") != F.col("hub_comp")) & self.near("a", "b", *bounds))
                .select(*_ordered("a", "b")).distinct())


def _more_hubs(members: DataFrame, spent: DataFrame, comp: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """The members of large buckets that still hold several components, and the hubs of this turn.

    Two nodes of different components are done once either was a hub, so a bucket is open
    while a node outside its largest component is not among ``spent`` (key, node).
    """
    m = kept(members.select("key", "band", "node").join(_near_at_hand(comp, comp.select("node", "comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    shares = m.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = kept(shares.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("most"), F.count(F.lit(1)).alias("comps"))
                   .filter("comps > 1").select("key", "most"))
    outside = kept(m.join(_near_at_hand(largest), "key").filter(F.col("comp") != F.col("most")).select("key", "node", "comp")
                   .join(_near_at_hand(spent), ["key", "node"], "left_anti"))
    # the draw is by node and turn alone, so neighbouring buckets tend to draw the same hub
    drawn = F.array(*[F.min(F.struct(F.xxhash64(F.lit(turn), F.lit(i), "node"), F.col("node")))["node"] for i in range(DRAWN)])
    left = kept(outside.groupBy("key").agg(F.count(F.lit(1)).alias("left"), drawn.alias("drawn")))
    hubs = kept(outside.join(_near_at_hand(left), "key").filter((F.col("left") <= FEW * GROWTH ** (turn - 1)) | F.array_contains("drawn", F.col("node")))
                .select("key", "node", "comp"))
    still = kept(m.join(_near_at_hand(left, left.select("key")), "key", "left_semi").select("key", "band", "node", "comp"))
    discard(m, largest, outside, left)
    return still, hubs


def _long(c: str, at: int) -> Column:
    """Eight bytes of a binary column as a number."""
    return F.conv(F.hex(F.substring(c, at, 8)), 16, -10).cast("long")


def _hex(c: str) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def near_groups(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``th`` (hash of the text), ``n`` (size of its set), ``node``,
    ``component_id`` (smallest id reachable over links of at least ``percent`` hundredths) and
    ``stays`` (the component's one node that stays, by smallest id)."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    rows = written(source.mapInArrow(_signatures(shingle), SIGNATURE), "signatures")
    worded = rows.filter(F.col("node").isNotNull())
    # copies of a set fold in the map task
    nodes = (worded.groupBy("node").agg(F.min(F.struct(nullable_key("id").alias("k"), "id", "th")).alias("first"),
                                        F.min("id").alias("least_id"), F.first("n").alias("n"),
                                        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    nodes = written(nodes, "nodes")
    plain = written(rows.select("id", "th", "n", "node"), "rows")
    discard(rows)
    # most keys are shuffled to be dropped, so their rows are three numbers: the node in two, the band in the key
    keys = nodes.select(_long("node", 1).alias("high"), _long("node", 9).alias("low"), F.explode("bands").alias("key"))
    shared = kept(keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    members = kept(keys.join(shared, "key").select(
        "key", F.unhex(F.concat(_hex("high"), _hex("low"))).alias("node"),
        (F.col("key").bitwiseAND(BANDS - 1) + 1).cast("int").alias("band"), "m"))
    discard(shared)

    met = kept(members.select("node").distinct())
    brief = kept(nodes.join(met, "node", "left_semi").select(
        "node", "n", "sketch", nullable_key("first.id").alias("k"), "first.th",
        F.transform("bands", lambda x: F.shiftright(x, 32).cast("int")).alias("bands")))
    wanted = brief.select("th").distinct()
    near = source.join(F.broadcast(wanted), "th", "left_semi") if met.count() <= BROADCAST_NODES else source
    texts = near.withColumn("k", nullable_key("id")).join(brief.select("node", "k", "th"), ["k", "th"])
    if _repeats(plain):
        texts = texts.dropDuplicates(["node"])
    ids = written(nodes.select("node", "least_id"), "ids")
    discard(nodes)
    sets = written(texts.select("node", "text").mapInArrow(_sets(shingle), "node binary, shingles binary"), "sets")
    links = _Links(brief, sets, percent)

    large = kept(members.filter(F.col("m") > SMALL).select("key", "band", "node", F.col("node").alias("comp")))
    # the first hubs tend to be the same in every bucket of a group of copies: the smallest by hashes of the node
    drawn = [F.min(F.struct(F.xxhash64(F.lit(-i), "node"), F.col("node")))["node"] for i in range(FIRST_HUBS)]
    hubs = kept(large.groupBy("key").agg(F.array(*drawn).alias("drawn"))
                .select("key", F.explode(F.array_distinct("drawn")).alias("node")).withColumn("comp", F.col("node")))
    links.nodes = brief = kept(brief.join(_shared_sizes(large.select("node").distinct(), sets), "node", "left")
                               .withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0))))
    first = links.of_small(members.filter(F.col("m") <= SMALL)).unionByName(links.of_hubs(large, hubs))
    found = links.confirmed(first.distinct())
    comp = components(found)
    spent = kept(hubs.select("key", "node"))
    discard(hubs, found, members)
    turn = 1
    while True:
        still, hubs = _more_hubs(large, spent, comp, turn)
        discard(large)
        if hubs.isEmpty():
            break
        if turn == 1:  # the open buckets of later turns are among these
            open_sets = sets.join(still.select("node").distinct(), "node", "left_semi").select("node", "shingles")
            links.nodes = sharp = kept(brief.join(open_sets.mapInArrow(_cells, "node binary, cells array<long>, over long"), "node"))
            discard(brief)
            brief = sharp
        found = links.confirmed(links.of_hubs(still, hubs))
        comp = _joined(comp, found)
        used = kept(spent.unionByName(hubs.select("key", "node")))
        discard(found, spent, hubs)
        spent, large = used, still
        turn += 1
    discard(still, hubs, spent, sets, brief, met)

    named = ids.join(_near_at_hand(comp, comp.select("node", "comp")), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = kept(named)
    order = F.struct(F.col("least_id").isNull().alias("a"), F.col("least_id").alias("b"), F.col("node").alias("c"))
    least = kept(named.groupBy("comp").agg(F.min("least_id").alias("component_id"), F.min(order)["c"].alias("stays")))
    of_node = kept(named.join(least, "comp").select("node", "component_id", (F.col("node") == F.col("stays")).alias("stays")))
    return (plain.filter(F.col("node").isNotNull()).join(of_node, "node")
            .select("id", "th", "n", "node", "component_id", "stays")
            .unionByName(plain.filter(F.col("node").isNull())
                         .select("id", "th", "n", "node", F.col("id").alias("component_id"), F.lit(True).alias("stays"))))


def _repeats(rows: DataFrame) -> bool:
    """Whether any row repeats id and text."""
    return not rows.groupBy("id", "th").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").isEmpty()


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with their own columns.  Texts without
    words all stay."""
    g = kept(near_groups(docs, shingle, percent, id_col, text_col))
    k, th, one = fresh(docs, "k", "th", "one")
    stay = (g.filter("stays and (node is null or id <=> component_id)")
            .select(nullable_key("id").alias(k), F.col("th").alias(th), (F.col("n") > 0).alias(one)))
    keyed = docs.withColumn(k, nullable_key(f"`{id_col}`")).withColumn(th, F.xxhash64(f"`{text_col}`"))
    out = keyed.join(kept(stay.distinct()), [k, th])
    if _repeats(g.filter("stays and n > 0")):
        out = out.filter(~F.col(one)).unionByName(out.filter(F.col(one)).dropDuplicates([k, th]))
    return out.drop(k, th, one)
