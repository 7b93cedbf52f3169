"""Packing documents into token windows with a bounded number of open windows.

Each partition is tokenised and packed in one pass, without a shuffle: a fixed number of
windows is open, a piece goes to the open window that it fills best, and when it fits
none the fullest is filled up from the piece's head (if that is long enough to be worth
a cut) and emitted.  The windows still open at the end of a partition hold only
whole pieces; these are merged over partitions, a bounded number of partitions to a
task, until one task holds the last ones.

A null text is an empty document, whose only id is the end mark; a document longer than
a window is cut; documents that repeat are packed each; an empty table gives no pieces;
other columns are ignored.  Reruns over the same partitions give the same pieces.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import kept, ship

SCHEMA = ("id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "open boolean")
#: Texts are tokenised in slices of about this many characters, cut where a word ends.
SLICE = 1 << 20
#: A cut must leave at least this many ids on either side.
MIN_CUT = 16
#: Partitions whose open windows one task merges in a round.
FAN_IN = 64
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_ENCODINGS: dict = {}


def encoding(vocab: str):
    """The byte-level BPE of a ``tokenizers`` JSON file, run by the faster of the two libraries.

    Vocabulary, merges (by rank), word pattern and special tokens are all read from the
    file; ids are those of ``tokenizers.Tokenizer.from_file(vocab).encode(text,
    add_special_tokens=False)``.
    """
    if vocab not in _ENCODINGS:
        import json

        import tiktoken
        from tokenizers import pre_tokenizers

        with open(vocab, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {}
        for b, c in zip(_byte_order(), sorted(pre_tokenizers.ByteLevel.alphabet()), strict=True):
            byte_of[c] = b
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        _ENCODINGS[vocab] = tiktoken.Encoding("from_file", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODINGS[vocab]


#: Fixed value: the word pattern of byte-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_order() -> list[int]:
    """Bytes in the order of the byte-level alphabet's characters: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return plain + [b for b in range(256) if b not in set(plain)]


def slices(text: str) -> Iterator[str]:
    """Parts of a text whose ids add up to the text's: cut only before a space between two
    letters, where the pattern always ends a word."""
    at = 0
    while len(text) - at > SLICE:
        m = _SAFE_CUT.search(text, at + SLICE)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def token_ids(enc, text: str | None, end_id: int) -> np.ndarray:
    parts = [np.asarray(enc.encode_to_numpy(s, allowed_special="all"), dtype="<u4") for s in slices(text or "") if s]
    return np.concatenate([*parts, np.array([end_id], dtype="<u4")])


class Packer:
    """Open windows of one task.  ``add`` places a piece and emits rows of windows that close."""

    def __init__(self, window: int, most_open: int, first_id: int):
        self.window, self.most, self.next_id = window, most_open, first_id
        self.open: list[tuple[int, int, list]] = []  # (room, number, rows), sorted: the fullest first

    def _number(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def _put(self, at: int | None, row: tuple) -> Iterator[tuple]:
        room, number, rows = self.open.pop(at) if at is not None else (self.window, self._number(), [])
        rows.append((*row, number, self.window - room))
        room -= row[2]
        if room == 0:
            yield from rows
        else:
            bisect.insort(self.open, (room, number, rows), key=lambda w: w[:2])

    def add(self, piece: tuple, ids: np.ndarray | None) -> Iterator[tuple]:
        """``piece``: id, start, length, crc, doc_tokens.  Without ids it is never cut."""
        doc, start, length, crc, total = piece
        while True:
            fits = bisect.bisect_left(self.open, length, key=lambda w: w[0])
            if fits < len(self.open):
                yield from self._put(fits, (doc, start, length, crc, total))
                return
            if len(self.open) < self.most:
                yield from self._put(None, (doc, start, length, crc, total))
                return
            room = self.open[0][0]
            if ids is not None and room >= MIN_CUT and length - room >= MIN_CUT:
                yield from self._put(0, (doc, start, room, zlib.crc32(ids[:room].tobytes()), total))
                ids, start, length = ids[room:], start + room, length - room
                crc = zlib.crc32(ids.tobytes())
            else:
                yield from self.open.pop(0)[2]

    def close(self) -> Iterator[tuple]:
        for _, _, rows in self.open:
            yield from rows
        self.open = []


def _batch(rows: list[tuple], is_open: bool) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    arrays = [pa.array(c, pa.int64()) for c in cols] + [pa.array([is_open] * len(rows), pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _pack_partition(vocab: str, window: int, most_open: int, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoding(vocab)
        packer = Packer(window, most_open, TaskContext.get().partitionId() << 40)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                doc, ids = doc.as_py(), token_ids(enc, text.as_py(), end_id)
                for start in range(0, len(ids), window):
                    part = ids[start:start + window]
                    out += packer.add((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)), part)
            if out:
                yield _batch(out, False)
        if rows := list(packer.close()):
            yield _batch(rows, True)
    return run


def _merge(window: int, most_open: int, last: bool, turn: int):
    """Pieces of several partitions' open windows: the longest first, best fit."""
    def run(table: pa.Table) -> pa.Table:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        pieces = sorted(zip(*[table.column(n).to_pylist() for n in names[:5]], strict=True),
                        key=lambda p: (-p[2], p[3], str(p[0]), p[1]))
        numbers = min(table.column("sequence_id").to_pylist())
        # each round numbers its windows in a range of its own, above those of the partition's first pass
        packer = Packer(window, len(pieces), (numbers >> 40 << 40) + (1 << 39) + (turn << 32))
        done = [r for p in pieces for r in packer.add(p, None)]
        full = len(done)
        left = sorted(packer.open, key=lambda w: w[0])
        keep = 0 if last else most_open
        for room, _, rows in left[:max(0, len(left) - keep)]:
            done += rows
        full = len(done)
        for room, _, rows in left[max(0, len(left) - keep):]:
            done += rows
        cols = list(zip(*done, strict=True))
        return pa.table([*[pa.array(c, pa.int64()) for c in cols],
                         pa.array([False] * full + [not last] * (len(done) - full), pa.bool_())], names=names)
    return run


def pack(docs: DataFrame, vocab: str, window: int = 2048, most_open: int = 64, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: ``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Memory of a task: one Arrow batch of texts and the rows of ``most_open`` windows.  The
    windows left open are rows without ids, ``most_open`` windows a partition.
    """
    ship(docs.sparkSession)
    pieces = kept(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                  .mapInArrow(_pack_partition(vocab, window, most_open, end_id), SCHEMA))
    done, left = [pieces.filter("not open")], pieces.filter("open")
    groups = left.select(F.expr("sequence_id >> 40").alias("p")).distinct().count()
    turn = 0
    while groups:
        groups = -(-groups // FAN_IN) if groups > 1 else 1
        last = groups == 1
        merged = kept(left.withColumn("_g", F.pmod(F.expr("sequence_id >> 40"), F.lit(groups)))
                      .groupBy("_g").applyInArrow(_merge(window, most_open, last, turn), SCHEMA))
        turn += 1
        done.append(merged.filter("not open"))
        left = merged.filter("open")
        if last:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("open")
