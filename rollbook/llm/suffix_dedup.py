"""Removal of repeated byte strings by a sparse suffix array, sorted by a distributed merge sort
that is aware of common prefixes.

Every string of ``length`` bytes has an anchor: the place of its smallest hash of GRAM
bytes (the leftmost of equals).  Equal strings have the same anchor at the same distance,
so only suffixes that start at anchors are sorted.

1. One pass over the texts lists the anchors with the range of string starts that each
   has, and the fingerprint of its GRAM bytes.  Anchors whose fingerprint is unique have no
   equal and are left out (as in a merge sort by doubled prefixes, a string that is told
   apart early need not travel).
2. Tasks sort the suffixes of their documents into runs.  A run is cut at splitters drawn
   from a bounded sample and sent front-coded: of each suffix only what follows the
   prefix it shares with its predecessor.
3. A task merges the runs of its range with a loser tree whose nodes remember the prefix a
   loser shares with the winner, so that no prefix known to be equal is compared again.
   The merge yields each suffix's common prefix with its neighbours; a suffix whose
   longest one cannot hold the right part of any of its strings is done.
4. For the others, equal strings among neighbours are found by rolling 128-bit hashes of
   the strings themselves, distance by distance, and block by block: where two neighbours
   share less than GRAM bytes, no string of one side has an equal on the other.  A string
   whose right part a splitter of its range starts with may have equals in other ranges (a
   passage that very many documents share spans several ranges); the hashes of such strings
   are counted over all ranges.

Splitters compare suffix and then a hash of the place, so equal suffixes are dealt evenly
and no key, however hot, comes to one task.

A null text is empty; texts shorter than ``length`` keep all bytes; documents that repeat
are repeats of each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import nullable_key, ship, written
from rollbook.llm.hashing import BYTE, CHUNK, mixed, odd, powers, prefix_sums

GRAM = 64
#: Bytes of suffixes in a run, and in the range that one task merges.
RUN_BYTES, RANGE_BYTES = 12 << 20, 16 << 20
#: Rows of a batch that are taken up at a time, and suffixes after which a block may end.
SLICE_ROWS, BLOCK = 512, 8192
#: Most ranges, and suffixes sampled for each splitter as long as the sample stays bounded.
MOST_RANGES, SAMPLED, MOST_SAMPLED = 1 << 16, 48, 1 << 14
_POSITION = np.uint64((1 << 22) - 1)
_BASES = [odd("window 1"), odd("window 2")]
_BYTES = [np.array([odd(f"window {i} byte {b}") for b in range(256)], dtype=np.uint64) for i in (1, 2)]


# anchors

def _slide_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by doubling."""
    n, size = len(x) - w + 1, 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:n], x[w - size:w - size + n])


def _anchors(data: np.ndarray, ends: np.ndarray, length: int):
    """Of a buffer of texts, whose position i belongs to a text that ends at ends[i]: anchor, first and
    last start of its strings, fingerprint."""
    w = length - GRAM + 1
    total = prefix_sums(BYTE[data])
    grams = mixed((total[GRAM:] - total[:-GRAM]) * powers()[1][:len(data) - GRAM + 1])
    place = np.arange(len(grams), dtype=np.uint64)
    owner = (_slide_min((grams & ~_POSITION) | place, w) & _POSITION).astype(np.int64)
    start = np.flatnonzero(np.arange(len(owner)) + length <= ends[:len(owner)])
    if not len(start):
        return (np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)
    owner = owner[start]
    new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(start) != 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    a = owner[first]
    return a, start[first], start[last], grams[a]


def _text_anchors(texts: Iterable[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, anchors, first starts, last starts, fingerprints); short texts go through one buffer,
    a long one in parts that overlap by a string."""
    def buffer(some: list[tuple[int, int, bytes]]) -> Iterator:
        data = np.frombuffer(b"".join(b for _, _, b in some), dtype=np.uint8)
        if len(data) < length:
            return
        sizes = np.array([len(b) for _, _, b in some])
        offsets = np.cumsum(sizes) - sizes
        a, lo, hi, fp = _anchors(data, np.repeat(offsets + sizes, sizes), length)
        cut = np.searchsorted(lo, offsets).tolist() + [len(lo)]
        for (number, shift, _), offset, x, y in zip(some, offsets.tolist(), cut, cut[1:]):
            if y > x:
                d = shift - offset
                yield number, a[x:y] + d, lo[x:y] + d, hi[x:y] + d, fp[x:y]

    waiting, size = [], 0
    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        step = CHUNK // 2
        for at in range(0, max(1, len(text) - length + 1), step):
            part = text[at:at + step + length - 1]
            if waiting and size + len(part) > CHUNK:
                yield from buffer(waiting)
                waiting, size = [], 0
            waiting.append((number, at, part))
            size += len(part)
            if size >= CHUNK // 4:
                yield from buffer(waiting)
                waiting, size = [], 0
    if waiting:
        yield from buffer(waiting)


def _sliced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that what is made of texts is never there for a whole batch at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(a, SLICE_ROWS)


def _bytes(texts: pa.Array) -> Iterator[bytes]:
    for x in texts.cast(pa.binary()):
        yield x.as_buffer().to_pybytes() if x.is_valid else b""


def _list_anchors(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            ks, ths = batch.column(0), batch.column(1)
            rows = list(_text_anchors(_bytes(batch.column(2)), length))
            if rows:
                at = pa.array([r[0] for r in rows])
                lists = [pa.array([r[i] for r in rows], pa.list_(pa.int64())) for i in (1, 2, 3)]
                fps = pa.array([r[4].view(np.int64) for r in rows], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([ks.take(at), ths.take(at), *lists, fps],
                                                 names=["k", "th", "at", "lo", "hi", "fp"])
    return run


# runs

def _tie(k: str, th: int, at: int) -> bytes:
    return hashlib.blake2b(f"{k}|{th}|{at}".encode(), digest_size=8).digest()


def _suffixes(batch: pa.RecordBatch, length: int) -> Iterator[tuple]:
    """(suffix, tie, left part, k, th, anchor, first and last start)."""
    for k, th, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _bytes(batch.column(2)),
                                   batch.column(3).to_pylist(), strict=True):
        for p in places:
            a = p["at"]
            yield text[a:a + length], _tie(k, th, a), text[p["lo"]:a], k, th, a, p["lo"], p["hi"]


def _common(strings: list[bytes], width: int) -> np.ndarray:
    """Common prefix of each string with the one before it."""
    out = np.zeros(len(strings), dtype=np.int64)
    for a in range(0, len(strings), 8192):
        part = strings[max(0, a - 1):a + 8192]
        m = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in part), dtype=np.uint8).reshape(len(part), width)
        same = m[1:] == m[:-1]
        lcp = np.where(same.all(axis=1), width, same.argmin(axis=1))
        sizes = np.array([len(s) for s in part])
        out[max(1, a):a + len(part) - (a > 0)] = np.minimum(lcp, np.minimum(sizes[1:], sizes[:-1]))
    return out


def _encode(entries: list[tuple], length: int) -> bytes:
    """A front-coded run: entries sorted by (suffix, tie)."""
    lcp = _common([e[0] for e in entries], length)
    rest = [e[0][n:] for e, n in zip(entries, lcp.tolist(), strict=True)]
    keys = [e[3].encode() for e in entries]
    numbers = np.array([[e[4], e[5], e[6], e[7]] for e in entries], dtype="<i8")
    short = np.array([lcp, [len(r) for r in rest], [len(e[2]) for e in entries], [len(x) for x in keys]], dtype="<u4")
    body = b"".join([struct.pack("<q", len(entries)), short.tobytes(), numbers.tobytes(), *(e[1] for e in entries),
                     *rest, *(e[2] for e in entries), *keys])
    return zstandard.ZstdCompressor(level=3).compress(body)


def _decode(blob: bytes) -> tuple[list[int], list[tuple]]:
    """Common prefixes and entries of a run."""
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = struct.unpack_from("<q", body)[0]
    short = np.frombuffer(body, "<u4", 4 * n, 8).reshape(4, n).tolist()
    numbers = np.frombuffer(body, "<i8", 4 * n, 8 + 16 * n).reshape(n, 4).tolist()
    at = 8 + 48 * n
    ties = [body[at + 8 * i:at + 8 * i + 8] for i in range(n)]
    at += 8 * n
    parts = []
    for sizes in short[1:]:
        part = []
        for s in sizes:
            part.append(body[at:at + s])
            at += s
        parts.append(part)
    entries, before = [], b""
    for lcp, rest, left, key, tie, (th, a, lo, hi) in zip(short[0], *parts, ties, numbers, strict=True):
        before = before[:lcp] + rest
        entries.append((before, tie, left, key.decode(), th, a, lo, hi))
    return short[0], entries


def _runs(length: int, splitters: list[tuple[bytes, bytes]]):
    def cut(entries: list[tuple]) -> pa.RecordBatch:
        entries.sort(key=lambda e: e[:2])
        parts: dict[int, list] = {}
        for e in entries:
            parts.setdefault(bisect_right(splitters, e[:2]), []).append(e)
        return pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int32()),
                                           pa.array([_encode(v, length) for v in parts.values()], pa.binary())],
                                          names=["range", "run"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, size = [], 0
        for batch in _sliced(batches):
            for e in _suffixes(batch, length):
                entries.append(e)
                size += len(e[0]) + len(e[2]) + 200
                if size > RUN_BYTES:
                    yield cut(entries)
                    entries, size = [], 0
        if entries:
            yield cut(entries)
    return run


# merge

def _common_from(x: bytes, y: bytes, at: int) -> int:
    """Common prefix of two strings that share ``at`` bytes."""
    n = min(len(x), len(y))
    while at < n:
        a, b = x[at:at + 48], y[at:at + 48]
        if a != b:
            m = min(len(a), len(b))
            d = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
            return at + (m if d == 0 else m - (d.bit_length() + 7) // 8)
        at += 48
    return n


class LoserTree:
    """Merges sorted runs.  ``play`` gives (entry, common prefix with the entry before)."""

    def __init__(self, runs: list[tuple[list[int], list[tuple]]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.at = [0] * self.size
        self.now: list[tuple | None] = [r[1][0] if r[1] else None for r in runs] + [None] * (self.size - len(runs))
        #: Common prefix of a run's head with the last winner that it lost to.
        self.lcp = [0] * self.size
        self.loser = [0] * self.size

    def _wins(self, a: int, b: int) -> bool:
        """Whether the head of a comes before that of b; sets the loser's common prefix with the winner."""
        x, y = self.now[a], self.now[b]
        if x is None or y is None:
            return y is None
        if self.lcp[a] != self.lcp[b]:
            return self.lcp[a] > self.lcp[b]  # the loser leaves the last winner's prefix earlier, so it keeps its own
        s, t = x[0], y[0]
        n = _common_from(s, t, self.lcp[a])
        if n < len(s) and n < len(t):
            first = s[n] < t[n]
        elif len(s) != len(t):
            first = len(s) < len(t)
        else:
            first = x[1] <= y[1]
        self.lcp[b if first else a] = n
        return first

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        if self._wins(a, b):
            a, b = b, a
        self.loser[node] = a
        return b

    def play(self) -> Iterator[tuple[tuple, int]]:
        best = self._build(1)
        while self.now[best] is not None:
            yield self.now[best], self.lcp[best]
            lcps, entries = self.runs[best]
            entries[self.at[best]] = None  # a suffix that has been played is not held any longer
            self.at[best] += 1
            i = self.at[best]
            self.now[best], self.lcp[best] = (entries[i], lcps[i]) if i < len(entries) else (None, 0)
            node = (best + self.size) >> 1
            while node:
                other = self.loser[node]
                if not self._wins(best, other):
                    self.loser[node], best = best, other
                node >>= 1


# equal strings

def _window_hashes(entries: list[tuple], length: int) -> Iterator[list[np.ndarray]]:
    """For distance 0, 1, ... before the anchor: two hashes of each entry's string."""
    n, most = len(entries), max(len(e[2]) for e in entries)
    right = np.frombuffer(b"".join(e[0].ljust(length, b"\0") for e in entries), dtype=np.uint8).reshape(n, length).T
    left = np.frombuffer(b"".join(e[2].rjust(most, b"\0") for e in entries), dtype=np.uint8).reshape(n, most).T if most else None
    sums = []
    for base, table in zip(_BASES, _BYTES, strict=True):
        h = np.zeros(n, dtype=np.uint64)
        for i in range(length - 1, -1, -1):
            h = h * np.uint64(base) + table[right[i]]
        sums.append(h)
    top = [np.uint64(pow(b, length - 1, 1 << 64)) for b in _BASES]
    for o in range(most + 1):
        yield sums
        if o < most:
            # the string one byte to the left: its first byte comes from the left part, its last byte goes
            new = left[most - 1 - o]
            gone = right[length - 1 - o] if o < length else None
            sums = [table[new] + np.uint64(base) * (h - table[gone] * t)
                    for base, table, h, t in zip(_BASES, _BYTES, sums, top, strict=True)]


def _equal(entries: list[tuple], reach: np.ndarray, edge: np.ndarray, length: int) -> Iterator[list[tuple]]:
    """Rows (k, th, first, last start of strings with an equal here, three nulls) and, for strings whose right
    part a splitter starts with (``edge`` is what a suffix shares with one), so that they may have equals
    elsewhere, rows (k, th, start, start, hash 1, hash 2, count)."""
    n = len(entries)
    anchor = np.array([e[5] for e in entries])
    low = np.maximum(anchor - np.array([e[7] for e in entries]), length - reach)
    high = anchor - np.array([e[6] for e in entries])
    found = np.zeros((n, int(high.max()) + 2), dtype=bool)
    rows: list[tuple] = []
    for o, (h1, h2) in enumerate(_window_hashes(entries, length)):
        live = np.flatnonzero((low <= o) & (o <= high))
        if not len(live):
            continue
        live = live[np.lexsort((h2[live], h1[live]))]
        a, b = h1[live], h2[live]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        found[live[twice], o] = True
        first = np.concatenate([[True], ~same])
        out = np.flatnonzero(first & (edge[live] >= length - o))  # one row for each string at an edge; equals count as two
        for i in out.tolist():
            e = entries[live[i]]
            rows.append((e[3], e[4], e[5] - o, e[5] - o, a[i].view(np.int64).item(), b[i].view(np.int64).item(), 2 if twice[i] else 1))
            if len(rows) >= BLOCK:
                yield rows
                rows = []
    for at in range(0, n, BLOCK):
        part = found[at:at + BLOCK].astype(np.int8)
        step = np.diff(part, axis=1, prepend=np.int8(0))
        starts, ends = np.argwhere(step == 1), np.argwhere(step == -1)
        for (i, o), (_, stop) in zip(starts.tolist(), ends.tolist(), strict=True):
            e = entries[at + i]
            rows.append((e[3], e[4], e[5] - (stop - 1), e[5] - o, None, None, None))
        if len(rows) >= BLOCK:
            yield rows
            rows = []
    if rows:
        yield rows


def _merge_range(length: int, splitters: list[tuple[bytes, bytes]]):
    schema = pa.schema([("k", pa.string()), ("th", pa.int64()), ("first", pa.int64()), ("last", pa.int64()),
                        ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int32())])

    def block(entries: list[tuple], lcps: list[int], borders: list[bytes]) -> Iterator[pa.RecordBatch]:
        lcp = np.array([*lcps, 0])
        lcp[0] = 0
        edge = np.array([max((_common_from(e[0], s, 0) for s in borders), default=0) for e in entries])
        reach = np.maximum(np.maximum(lcp[:-1], lcp[1:]), edge)
        keep = np.flatnonzero(reach >= GRAM)
        if len(keep):
            for rows in _equal([entries[i] for i in keep], reach[keep], edge[keep], length):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)],
                                                 schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, runs = 0, []
        for batch in batches:
            for r, blob in zip(batch.column("range").to_pylist(), batch.column("run"), strict=True):
                number = r
                runs.append(_decode(blob.as_py()))
        borders = [s[0] for s in splitters[max(0, number - 1):number + 1]]
        entries, lcps = [], []
        for e, n in LoserTree(runs).play():
            if n < GRAM and len(entries) >= BLOCK:
                yield from block(entries, lcps, borders)
                entries, lcps = [], []
            entries.append(e)
            lcps.append(n)
        if entries:
            yield from block(entries, lcps, borders)
    return run


# the whole

def _splitters(source: DataFrame, anchors: DataFrame, count: int, length: int) -> list[tuple[bytes, bytes]]:
    """Cut points of about equal ranges, from a sample of suffixes of bounded size."""
    ranges = min(MOST_RANGES, -(-count * length // RANGE_BYTES))
    if ranges < 2:
        return []
    wanted = min(MOST_SAMPLED, SAMPLED * ranges)
    # a share of the anchors by hash; where the share gives more than wanted, the smallest hashes
    h = F.pmod(F.xxhash64("k", "th", "at"), F.lit(1 << 30))
    some = (anchors.withColumn("h", h).filter(F.col("h") < int(min(1.0, 1.5 * wanted / count) * (1 << 30)) + 1)
            .orderBy("h").limit(wanted).groupBy("k", "th").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("places")))

    def heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            got = [(e[0], e[1]) for e in _suffixes(batch, length)]
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], pa.binary()) for i in (0, 1)], names=["s", "tie"])

    rows = (source.join(F.broadcast(some), ["k", "th"]).select("k", "th", "text", "places")
            .mapInArrow(heads, "s binary, tie binary").collect())
    heads_ = sorted((bytes(r.s), bytes(r.tie)) for r in rows)
    return sorted({heads_[len(heads_) * i // ranges] for i in range(1, ranges)}) if heads_ else []


def repeated_starts(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k``, ``th`` (key of a document), ``spans``: ranges (first, last) of starts of strings of ``length``
    bytes that also start elsewhere.  Documents without any are left out."""
    spark = docs.sparkSession
    ship(spark)
    source = docs.select(nullable_key(id_col).alias("k"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    listed = written(source.filter(F.octet_length("text") >= length).mapInArrow(
        _list_anchors(length), "k string, th long, at array<long>, lo array<long>, hi array<long>, fp array<long>"), "anchors")
    one = listed.select("k", "th", F.explode(F.arrays_zip("at", "lo", "hi", "fp")).alias("x")).select("k", "th", "x.*")
    twice = written(one.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fp"), "twice")
    anchors = written(one.join(twice, "fp", "left_semi").select("k", "th", "at", "lo", "hi"), "repeated")
    count = anchors.count()
    splitters = _splitters(source, anchors, count, length)
    places = anchors.groupBy("k", "th").agg(F.collect_set(F.struct("at", "lo", "hi")).alias("places"))
    runs = (source.join(places, ["k", "th"]).select("k", "th", "text", "places")
            .mapInArrow(_runs(length, splitters), "range int, run binary"))
    merged = written(runs.groupBy("range").applyInArrow(
        _merge_range(length, splitters), "k string, th long, first long, last long, h1 long, h2 long, n int"), "merged")
    sure = merged.filter("h1 is null").select("k", "th", "first", "last")
    pending = merged.filter("h1 is not null")
    many = written(pending.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2"), "many")
    elsewhere = pending.filter("n = 1").join(many, ["h1", "h2"], "left_semi").select("k", "th", "first", "last")
    return (sure.unionByName(elsewhere).groupBy("k", "th")
            .agg(F.collect_list(F.struct("first", "last")).alias("spans")))


def _without(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            rows = []
            for text, spans in zip(_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                left, at, removed, runs = [], 0, 0, 0
                end = -1
                for first, last in sorted((s["first"], s["last"] + length) for s in spans or ()):
                    if first > end:
                        runs += 1
                        left.append(text[at:first])
                        removed += last - first
                        end = last
                    elif last > end:
                        removed += last - end
                        end = last
                    at = end
                left.append(text[at:])
                rows.append((len(text), removed, runs, b"".join(left)))
            cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the bytes that stay)."""
    spans = repeated_starts(docs, length, id_col, text_col)
    d = docs.select(F.col(id_col).cast("long").alias("id"), nullable_key(id_col).alias("k"), F.xxhash64(text_col).alias("th"),
                    F.col(text_col).alias("text"))
    return (d.join(spans, ["k", "th"], "left").select("id", "text", "spans")
            .mapInArrow(_without(length), "id long, n_bytes long, n_removed long, n_spans long, kept binary"))
