"""Quality rules by distribution divergence.

A document has two histograms: code points by character class, and words by the COMMON words
of its language (and one bin for all others).  Each is compared with its language's reference by
the Jensen-Shannon distance; a document too far from either is rejected.  The words come in
by how many documents hold them, and a reference is the median of each bin over the language's
different texts, so neither a hot group of copies nor a few very long or odd texts bend it.

Guards: a histogram of fewer than MIN_CHARS characters (MIN_WORDS words) is not judged, and a
language has a reference from MIN_DOCUMENTS judged documents on.  Documents of a null or rarer
language are judged by their characters alone, against the reference of all documents.

Before that stand base rules on counts: too few words, or too many words inside repeated
8-word windows.

Null and empty texts have no words and fail the base rules.  Texts of any length are read whole.
Rows that repeat are judged alike; ids are passed on as they are, other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import discard, kept, nullable_key, ship

WINDOW = 8
MIN_TOTAL_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Common words of a language.
COMMON = 64
MIN_CHARS, MIN_WORDS, MIN_DOCUMENTS = 100, 50, 30
#: Largest Jensen-Shannon distance (the root of the divergence in bits) of characters and of words,
#: beyond what a text of the same length drawn from the reference itself would show.
MAX_CHARS, MAX_WORDS = 0.2, 0.23
#: Shares are counted in so many steps for the medians.
STEPS = 4096
#: Languages whose word lists and references are broadcast; more are joined by a shuffle.
BROADCAST_LANGUAGES = 512
#: Different words that a task counts before it writes; bytes of text that are looked at together.
COUNTED, SLICE = 500_000, 1 << 22

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_DROP = b".,;:!?\"()"
ALL = "*"


def _classes() -> np.ndarray:
    """Class of each byte; bytes inside a UTF-8 sequence have none (-1), its first byte speaks for the character."""
    out = np.full(256, 8)  # other ASCII marks
    for b in range(256):
        c = chr(b)
        if b >= 0x80:
            out[b] = -1 if b < 0xC0 else 9 if b == 0xC2 else 10 if b < 0xD0 else 11 if b < 0xE0 else 12 if b < 0xF0 else 13
        elif c.islower():
            out[b] = 0
        elif c.isupper():
            out[b] = 1
        elif c.isdigit():
            out[b] = 2
        elif c in " \t":
            out[b] = 3
        elif c in "\n\r\x0b\x0c":
            out[b] = 4
        elif c in ".,;:!?'\"()-":
            out[b] = 5
        elif c in _SYMBOLS:
            out[b] = 6
        elif b < 32 or b == 127:
            out[b] = 7
    return out


_CLASS = _classes()
CLASSES = int(_CLASS.max()) + 1
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = "id long, lang string, h long, " + ", ".join(f"{c} long" for c in COUNTS) + ", chars array<long>, words array<long>"


def plain_words(text: bytes) -> list[bytes]:
    """Words as they are looked up: A-Z lower, without punctuation."""
    return text.lower().translate(None, _DROP).split()


def repeated_words(bags: list[list[bytes]]) -> list[int]:
    """Words of each text that lie in an 8-word window which the text holds twice or more.

    Windows are numbered by doubling: pairs of words, pairs of pairs, pairs of those.
    """
    sizes = np.array([len(b) for b in bags])
    place: dict[bytes, int] = {}
    ids = np.array([place.setdefault(w, len(place)) for b in bags for w in b], dtype=np.int64)
    out = np.zeros(len(bags), dtype=np.int64)
    if len(ids) < WINDOW:
        return out.tolist()
    owner = np.repeat(np.arange(len(bags)), sizes)
    step = 1
    while step < WINDOW:
        _, ids = np.unique(ids[:-step] * (int(ids.max()) + 1) + ids[step:], return_inverse=True)
        step *= 2
    inside = owner[:len(ids)] == owner[WINDOW - 1:]
    at = np.flatnonzero(inside)
    _, which, often = np.unique(ids[at] * len(bags) + owner[at], return_inverse=True, return_counts=True)
    again = at[often[which] > 1]
    edge = np.zeros(len(owner) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    np.add.at(out, owner, np.cumsum(edge[:-1]) > 0)
    return out.tolist()


def character_classes(texts: list[bytes]) -> list[list[int]]:
    data = _CLASS[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    cell = np.repeat(np.arange(len(texts)), [len(t) for t in texts]) * (CLASSES + 1) + data + 1
    return np.bincount(cell, minlength=len(texts) * (CLASSES + 1)).reshape(len(texts), -1)[:, 1:].tolist()


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts in runs of about SLICE characters."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE or i + 1 == len(texts):
            yield first, [x or "" for x in texts[first:i + 1]]
            first, size = i + 1, 0


def _encoded(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def _holders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, documents that hold it), as far as a task has counted."""
    held: dict[str, Counter] = defaultdict(Counter)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.binary()),
                                              pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = plain_words(text.encode("utf-8", "surrogatepass"))
            if len(words) >= MIN_WORDS:
                held[lang].update(set(words))
            if sum(map(len, held.values())) >= COUNTED:
                yield from rows()
    yield from rows()


def common_words(docs: DataFrame) -> DataFrame:
    """``lang``, ``common``: the COMMON words that most documents of the language hold, ties by bytes."""
    named = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    held = named.mapInArrow(_holders, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    return (held.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= COMMON)
            .groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "word"))), lambda x: x["word"]).alias("common")))


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, langs, hashes, texts, commons = (c.to_pylist() for c in batch.columns)
        for first, some in _slices(texts):
            raw = _encoded(some)
            bags = [t.split() for t in raw]
            rows = {"n_words": [len(b) for b in bags], "word_chars": [len(t) - sum(map(t.count, _BLANKS)) for t in some],
                    "n_symbols": [sum(map(t.count, _SYMBOLS)) for t in some], "n_dup_lines": [], "n_repeat_words": repeated_words(bags)}
            for t in some:
                lines = [x for x in t.split("\n") if x.strip(_BLANKS)]
                rows["n_dup_lines"].append(len(lines) - len(set(lines)))
            words = []
            for t, common in zip(raw, commons[first:], strict=False):
                bag = plain_words(t)
                count = Counter(bag)
                hits = [count[w] for w in common or ()]
                words.append([*hits, len(bag) - sum(hits)] if common else [])
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[first:first + len(some)], pa.int64()), pa.array(langs[first:first + len(some)], pa.string()),
                 pa.array(hashes[first:first + len(some)], pa.int64()), *[pa.array(rows[c], pa.int64()) for c in COUNTS], pa.array(character_classes(raw), longs), pa.array(words, longs)],
                names=["id", "lang", "h", *COUNTS, "chars", "words"])


def _shares(lang, counts: str) -> list:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return [lang.alias("lang"), F.posexplode(F.transform(counts, lambda x: F.floor(x * STEPS / total).cast("int"))).alias("bin", "share")]


def medians(features: DataFrame, kind: str) -> DataFrame:
    """``lang``, ``kind``: the median share of each bin, in STEPS.  Shares are counted before anything is
    gathered: a language has at most bins * STEPS counts, however many documents it has."""
    counts = features.groupBy("lang", "bin", "share").agg(F.count(F.lit(1)).alias("n"))
    bins = Window.partitionBy("lang", "bin")
    upto = F.sum("n").over(bins.orderBy("share"))
    total = F.sum("n").over(bins)
    middle = (counts.select("lang", "bin", "share", upto.alias("upto"), total.alias("total"))
              .filter((F.col("upto") * 2 >= F.col("total")) & (F.col("total") >= MIN_DOCUMENTS))
              .groupBy("lang", "bin").agg(F.min("share").alias("share")))
    return middle.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "share"))), lambda x: x["share"]).alias(kind))


def references(features: DataFrame) -> DataFrame:
    """``lang``, ``ref_chars``, ``ref_words``; the language ALL has characters only.  Texts count once (by
    64-bit hash) in a language; copies fold in the map task."""
    base = features.filter(~F.col("base_failed")).dropDuplicates(["lang", "h"])
    chars = base.filter(F.aggregate("chars", F.lit(0).cast("long"), lambda a, x: a + x) >= MIN_CHARS)
    words = base.filter(F.col("lang").isNotNull() & (F.col("n_words") >= MIN_WORDS) & (F.size("words") > 0))
    by_chars = medians(chars.select(*_shares(nullable_key("lang"), "chars"))
                       .unionByName(chars.select(*_shares(F.lit(ALL), "chars"))), "ref_chars")
    by_words = medians(words.select(*_shares(nullable_key("lang"), "words")), "ref_words")
    return by_chars.filter("lang <> '-'").join(by_words, "lang", "left")


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Root of the Jensen-Shannon divergence in bits of each row of counts from its row of references, less
    the (bins - 1) / (8 n ln 2) that n draws from the reference diverge by on average."""
    chance = (counts.shape[1] - 1) / (8 * np.log(2) * np.maximum(counts.sum(axis=1), 1))
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.maximum((left + right) / 2 - chance, 0))


def _judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds both distances; null where a guard holds."""
    for batch in batches:
        out = {}
        for kind, least, total in (("chars", MIN_CHARS, None), ("words", MIN_WORDS, "n_words")):
            counts, refs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (kind, f"ref_{kind}"))
            sizes = [sum(c) for c in counts] if total is None else batch.column(batch.schema.get_field_index(total)).to_pylist()
            value = np.full(len(counts), np.nan)
            at = [i for i, (c, r, n) in enumerate(zip(counts, refs, sizes, strict=True)) if r and n >= least and len(c) == len(r)]
            if at:
                value[at] = js_distance(np.array([counts[i] for i in at], float), np.array([refs[i] for i in at], float))
            out[kind] = pa.array([None if np.isnan(v) else float(v) for v in value], pa.float64())
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("id", *COUNTS, "base_failed")]
        yield pa.RecordBatch.from_arrays([*keep, out["chars"], out["words"]],
                                         names=["id", *COUNTS, "base_failed", "char_distance", "word_distance"])


def quality(docs: DataFrame, max_chars: float = MAX_CHARS, max_words: float = MAX_WORDS, id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id``, the counts, ``base_failed``, ``char_distance`` and ``word_distance`` (null where not
    judged) and ``kept`` of each row."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    common = kept(common_words(source))
    hint = F.broadcast if common.count() <= BROADCAST_LANGUAGES else (lambda df: df)
    with_words = source.join(hint(common), "lang", "left").select("id", "lang", F.xxhash64("text").alias("h"), "text", "common")
    features = with_words.mapInArrow(_features, FEATURES)
    few = F.col("n_words") < MIN_TOTAL_WORDS
    features = kept(features.withColumn("base_failed", few | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT)))
    refs = kept(references(features))
    hint = F.broadcast if refs.count() <= BROADCAST_LANGUAGES else (lambda df: df)
    # a language without a reference is judged by the one of all documents; of these there is one row
    known = features.withColumn("key", nullable_key("lang")).join(hint(refs.withColumnRenamed("lang", "key")), "key", "left")
    every = refs.filter(F.col("lang") == ALL).select(F.col("ref_chars")).limit(1).scalar()
    known = known.withColumn("ref_chars", F.coalesce("ref_chars", every)).drop("key")
    schema = "id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, char_distance double, word_distance double"
    near = (F.coalesce(F.col("char_distance") <= max_chars, F.lit(True)) & F.coalesce(F.col("word_distance") <= max_words, F.lit(True)))
    return known.mapInArrow(_judged, schema).withColumn("kept", ~F.col("base_failed") & near)
