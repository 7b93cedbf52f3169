"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

The instances are words, the labelled sentences and documents are bags of them: a bag
is toxic as far as its most toxic words are.  Two words are compared by the gap-weighted
subsequence kernel (all common subsequences of ORDER letters, each weighted by DECAY to
the power of the lengths it spans), so letters put between those of an insult, or other
endings, lower the value but do not bring it to zero; a word that holds a whole landmark with
one letter put in counts as if it held it without (``_one_gap``).  Letters
stretched over blanks ("i d i o t") are read as one word too.  Landmarks are the words
and word beginnings that tell toxic from clean training documents best; the Nystroem
map of the kernel to them is the input of a squared-hinge SVM, and a logistic curve
turns the TOP largest decision values of a document into a score: one word that can be
nothing else is enough, words that also occur in clean texts need company.

Training uses a bounded sample of labelled rows (PER_CLASS documents of each label,
chosen by hash among texts of at most MAX_TRAIN_CHARS characters); scoring reads every
word of every text.  Label, language, source and id are no input of a score.

A null or empty text has no words and gets the score of that; without training rows of
both labels every score is 0; a null id is not held out; rows that repeat are scored
each; rows of ``labels`` that repeat an id count once, as toxic if any of them says so;
other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import ship, slices

ORDER, DECAY = 4, 0.6
#: Power of the kernel's share that a landmark's feature takes.
POWER = 2.0
#: Power of a word's own kernel value, against the landmark's, that divides it (0.5 would be the cosine).
LONGER = 0.15
LANDMARKS = 32
#: Beginnings of words that can be landmarks have so many letters.
STEMS = range(4, 9)
PER_CLASS = 800
MAX_TRAIN_CHARS = 50_000
#: Letters of a word that the kernel reads at once; longer words are read in overlapping parts.
PART = 24
#: A landmark counts for a word only if the word has this share of its different letters.
SHARED = 0.7
#: Scores of words that a worker remembers.
REMEMBER = 200_000
THRESHOLD = 0.7
#: Different words of a document that count.
TOP = 3

_STRETCHED = re.compile(r"(?<!\S)\w(?:[\s.*_-]\w){3,}(?!\S)")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "…“”„«»¿¡’‘"


def words_of(text: str) -> list[str]:
    """Lower-cased words without punctuation at their edges, and stretched words joined."""
    low = text.lower()
    words = [w.strip(_EDGES) for w in low.split()]
    words += ["".join(ch for ch in m if ch.isalnum()) for m in _STRETCHED.findall(low)]
    return [w for w in words if w]


def _parts(word: str) -> list[str]:
    """The word after a start mark; a long one in parts that overlap by half."""
    if len(word) <= PART:
        return ["^" + word]
    return ["^" + word[:PART]] + [word[i:i + PART] for i in range(PART // 2, len(word) - PART // 2, PART // 2)]


def _codes(words: list[str]) -> np.ndarray:
    """(length, n) code points; 0 pads."""
    n = max(map(len, words), default=1)
    flat = np.zeros((len(words), n), dtype="<u4")
    for i, w in enumerate(words):
        flat[i, :len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.ascontiguousarray(flat.T)


def _letters(words: list[str]) -> np.ndarray:
    """Bit sets of the letters (63 classes of code points)."""
    c = _codes(words)
    bits = np.where(c > 0, np.left_shift(np.uint64(1), (c % 63).astype(np.uint64)), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=0)


def kernel_pairs(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of ORDER of each pair of columns, by the usual recursion
    over both words, for all pairs at once."""
    n = s.shape[1]
    t_len = t.shape[0]
    total = np.zeros(n, dtype=np.float32)
    # prefix[q][j]: weighted common subsequences of q letters of the word so far and t[:j]
    prefix = [np.zeros((t_len + 1, n), dtype=np.float32) for _ in range(ORDER)]
    prefix[0][:] = 1
    square = np.float32(DECAY * DECAY)
    decay = np.float32(DECAY)
    for i in range(s.shape[0]):
        same = (t == s[i]) & (s[i] > 0)
        live = s[i] > 0
        total += square * (same * prefix[ORDER - 1][:-1]).sum(axis=0, dtype=np.float32)
        for q in range(ORDER - 1, 0, -1):
            run = np.zeros(n, dtype=np.float32)
            step = square * same * prefix[q - 1][:-1]
            grown = prefix[q] * decay
            for j in range(t_len):
                run = run * decay + step[j]
                grown[j + 1] += run
            prefix[q] = np.where(live, grown, prefix[q])
    return total


def _one_gap(s: np.ndarray, t: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether s begins with all letters of t (a start mark and ``lengths`` - 1 letters) and one letter put
    between two of them: the common subsequence of t's full length, with one gap of one."""
    n = t.shape[0]
    wide = np.zeros((n + 1, s.shape[1]), dtype=s.dtype)
    wide[:min(n + 1, len(s))] = s[:n + 1]
    at = np.arange(n)[:, None]
    past = at >= lengths[None, :]
    before = np.logical_and.accumulate((wide[:n] == t) | past, axis=0)
    after = np.logical_and.accumulate(((wide[1:] == t) | past)[::-1], axis=0)[::-1]
    inside = (at[1:] >= 2) & ~past[1:]
    return (before[:-1] & after[1:] & inside).any(axis=0)


def _growth(marks: list[str]) -> np.ndarray:
    """The most by which an unlike letter put inside multiplies the own kernel value of each."""
    out = np.ones(len(marks), dtype=np.float32)
    made = [(j, m[:a] + "\ue000" + m[a:]) for j, m in enumerate(marks) for a in range(2, len(m))]
    if made:
        owner, codes = np.array([j for j, _ in made]), _codes([x for _, x in made])
        plain = _codes(marks)
        whole = np.maximum(kernel_pairs(plain, plain), 1e-12)
        np.maximum.at(out, owner, kernel_pairs(codes, codes) / whole[owner])
    return out


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """For each word, the share of each landmark's own kernel value that the two have in common, to
    POWER; 0 where too few letters are shared.  What a word has besides lowers it little, one letter
    put inside the landmark not at all."""
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    if not words or not landmarks:
        return out
    parts = [(i, p) for i, w in enumerate(words) for p in _parts(w)]
    owner = np.array([i for i, _ in parts])
    strings = [p for _, p in parts]
    marks = ["^" + x[:PART] for x in landmarks]
    have, need = _letters(strings), _letters(marks)
    least = np.ceil(np.bitwise_count(need) * SHARED)
    sizes, mark_sizes = np.array([len(p) for p in strings]), np.array([len(m) for m in marks])
    whole = np.maximum(kernel_pairs(_codes(marks), _codes(marks)), 1e-12)
    growth = _growth(marks)
    for length in np.unique(sizes):  # words of like length together, so little is padded
        at = np.flatnonzero(sizes == length)
        for a in range(0, len(at), 20_000):
            some = at[a:a + 20_000]
            w, m = np.nonzero(np.bitwise_count(have[some, None] & need[None, :]) >= least[None, :])
            if not len(w):
                continue
            codes, mark_codes = _codes([strings[i] for i in some]), _codes(marks)
            used = np.unique(w)
            own = np.ones(len(some), dtype=np.float32)
            own[used] = kernel_pairs(codes[:, used], codes[:, used])
            for b in range(0, len(w), 50_000):
                wb, mb = w[b:b + 50_000], m[b:b + 50_000]
                share = kernel_pairs(codes[:, wb], mark_codes[:, mb]) / whole[mb]
                longer = own[wb] / whole[mb]
                gap = _one_gap(codes[:, wb], mark_codes[:, mb], mark_sizes[mb]) & (share < 1)
                share, longer = np.where(gap, 1, share), np.where(gap, longer / growth[mb], longer)
                share = np.minimum(share / np.maximum(longer, 1) ** LONGER, 1)
                np.maximum.at(out, (owner[some[wb]], mb), share ** POWER)
    return out


class Model:
    """Landmarks, weights on kernel values, and the logistic curve; small enough to ship."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, bias: float, slopes: list[float], shift: float):
        self.landmarks, self.weights, self.bias, self.slopes, self.shift = landmarks, weights, bias, slopes, shift

    def decide(self, words: list[str]) -> np.ndarray:
        """Decision values; a word with marks inside counts with or without them, whichever is more toxic."""
        value = kernel(words, self.landmarks) @ self.weights + self.bias
        marked = [i for i, w in enumerate(words) if not w.isalnum()]
        if marked:
            bare = ["".join(c for c in words[i] if c.isalnum()) for i in marked]
            value[marked] = np.maximum(value[marked], kernel(bare, self.landmarks) @ self.weights + self.bias)
        return value

    def score(self, decisions: Iterable[float]) -> float:
        """Score of a bag with these decision values."""
        top = _top(decisions, self.bias)
        x = sum(a * v for a, v in zip(self.slopes, top, strict=True)) + self.shift
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))


def _top(decisions: Iterable[float], bias: float) -> list[float]:
    return (heapq.nlargest(TOP, set(decisions)) + [bias] * TOP)[:TOP]


def _choose_landmarks(toxic: Counter, clean: Counter, n_toxic: int, n_clean: int) -> list[str]:
    """Words by the z value of their document rates, skipping those close to one chosen before."""
    def z(w: str) -> float:
        a, b = toxic[w], clean[w]
        p = (a + b) / (n_toxic + n_clean)
        return (a / n_toxic - b / n_clean) / math.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_clean) + 1e-12)

    ranked = sorted(((z(w), w) for w in toxic if len(w) >= ORDER and toxic[w] > 1), key=lambda x: (-x[0], -len(x[1]), x[1]))
    ranked = [w for v, w in ranked[:12 * LANDMARKS] if v > 2.5]
    similar, chosen = kernel(ranked, ranked), []
    for i in range(len(ranked)):
        if len(chosen) < LANDMARKS and (not chosen or max(similar[i, chosen].max(), similar[chosen, i].max()) < 0.8):
            chosen.append(i)
    return [ranked[i] for i in chosen]


def _strings(bag: list[str]) -> set[str]:
    """Words of a document and their beginnings."""
    return set(bag) | {w[:n] for w in bag for n in STEMS if n < len(w)}


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by Newton steps on the active rows."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = np.full(x1.shape[1], ridge)
    reg[-1] = 1e-6
    c = weight / weight.sum()
    for _ in range(30):
        on = y * (x1 @ w) < 1
        a = x1[on] * c[on, None]
        new = np.linalg.solve(a.T @ x1[on] + np.diag(reg), a.T @ y[on])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def _logistic(d: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """Slopes and shift of a logistic curve over decision values, with smoothed labels."""
    pos, neg = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.hstack([d, np.ones((len(d), 1))])
    n = x.shape[1]
    w = np.zeros(n)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(n)
        w += np.linalg.solve(h, x.T @ (t - p) - 1e-2 * w)
    return w[:-1].tolist(), float(w[-1])


def fit(texts: list[str], toxic: list[int]) -> Model | None:
    """None without texts of both labels or without telling words."""
    bags = [sorted(set(words_of(t))) for t in texts]
    y = np.array(toxic)
    if not (y == 1).any() or not (y == 0).any():
        return None
    df = [Counter(w for b, k in zip(bags, y, strict=True) if k == label for w in _strings(b)) for label in (0, 1)]
    landmarks = _choose_landmarks(df[1], df[0], int((y == 1).sum()), int((y == 0).sum()))
    if not landmarks:
        return None
    vocabulary = sorted(set().union(*bags))
    place = {w: i for i, w in enumerate(vocabulary)}
    members = [np.array([place[w] for w in b], dtype=int) for b in bags]
    clean_df = np.zeros(len(vocabulary))
    for b, label in zip(members, y, strict=True):
        clean_df[b] += label == 0
    tell = np.array([df[1][w] for w in vocabulary]) - clean_df * (y == 1).sum() / (y == 0).sum()
    k = kernel(vocabulary, landmarks)
    sure = [w for w in vocabulary if df[1][w] > 2 and df[0][w] == 0 and w in df[1]]
    strange = _disturbed(sure)
    weights, bias, value_of = _witnesses(k, kernel(landmarks, landmarks), members, y, clean_df, tell,
                                         kernel(strange, landmarks))
    best = np.array([_top(value_of[b].tolist(), bias) for b in members])
    slopes, shift = _logistic(best, y.astype(float))
    return Model(landmarks, weights, bias, slopes, shift)


def _disturbed(words: list[str]) -> list[str]:
    """Telling words with one letter of the alphabet put in, or one letter doubled, at a place inside
    that follows from the word."""
    out = []
    for w in words:
        at = 1 + zlib.crc32(w.encode()) % max(1, len(w) - 1)
        other = "aeinorst"[zlib.crc32(w[::-1].encode()) % 8]
        out += [w[:at] + other + w[at:], w[:at] + w[at - 1] + w[at:]]
    return out


def _witnesses(k, gram, members, y, clean_df, tell, disturbed) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights on kernel values, bias, and decision values of the vocabulary.

    The witness of a document is its most toxic word under the model so far.  Witnesses of
    toxic documents are the positive instances; the negative ones are the clean words,
    by the number of clean documents, and the witnesses of these once more.
    """
    value, vector = np.linalg.eigh((gram + gram.T).astype(float) / 2)
    keep = value > 1e-3
    to_features = vector[:, keep] / np.sqrt(value[keep])  # the Nystroem map
    features = k @ to_features
    alike = k.any(axis=1)
    negative = np.flatnonzero((clean_df > 0) & alike)
    nothing = np.zeros((1, features.shape[1]))
    value_of = np.where(alike, tell, -np.inf)
    sure = np.flatnonzero((clean_df == 0) & (tell > 2) & alike)
    spread = np.vstack([features[sure], disturbed @ to_features])
    often = np.concatenate([tell[sure], np.full(len(disturbed), 0.25 * tell[sure].sum() / max(1, len(disturbed)))])
    for _ in range(5):
        top = np.array([b[np.argmax(value_of[b])] if len(b) else -1 for b in members])
        pos, neg = top[(y == 1) & (top >= 0)], top[(y == 0) & (top >= 0)]
        pos, neg = pos[alike[pos]], neg[alike[neg]]
        x = np.vstack([features[pos], spread, features[negative], features[neg], nothing])
        labels = np.concatenate([np.ones(len(pos) + len(spread)), -np.ones(len(negative) + len(neg) + 1)])
        common = clean_df[negative]
        weight = np.concatenate([np.full(len(pos), 1 / max(1, len(pos))), 2 * often / max(1, often.sum()), common / max(1, common.sum()),
                                 np.full(len(neg), 1 / max(1, len(neg))), [0.2]])
        w, bias = _svm(x, labels, weight)
        value_of = features @ w + bias
    return to_features @ w, bias, value_of


def training_rows(docs: DataFrame, labels: DataFrame, usable, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> list[tuple[str, int]]:
    """At most PER_CLASS texts of each label; the ids chosen are a table of bounded size, so it is broadcast."""
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")).filter(usable(F.col("id"))))
    some = None
    for label in (0, 1):
        part = known.filter(F.col("y") == label).orderBy(F.xxhash64("id"), "id").limit(PER_CLASS)
        some = part if some is None else some.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull() & (F.char_length("text") <= MAX_TRAIN_CHARS))
    rows = texts.join(F.broadcast(some), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    return [(r.text, r.y) for r in rows.orderBy("id").collect()]


def _scores(model: Model | None, texts: pa.Array, known: dict[str, float]) -> list[float]:
    """Score of each text; ``known`` remembers the decision values of words.  Only the different words of
    a few texts are held at a time."""
    out: list[float] = []
    for _, some in slices(texts, rows=4096, chars=1 << 23):
        if model is None:
            out += [0.0] * len(some)
            continue
        bags = [set(words_of(t)) if t else () for t in some]
        if len(known) > REMEMBER:
            known.clear()
        new = sorted({w for b in bags for w in b if w not in known})
        for a in range(0, len(new), 20_000):
            part = new[a:a + 20_000]
            known.update(zip(part, model.decide(part).tolist(), strict=True))
        out += [model.score(map(known.__getitem__, b)) for b in bags]
    return out


def _score(model: Model | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            scores = _scores(model, batch.column(1), known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])
    return run


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``score`` of each row, in one pass over the texts."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _score(model), "id long, score double")


def _clean(model: Model | None, threshold: float, at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            yield batch.filter(pa.array([s < threshold for s in _scores(model, batch.column(at), known)], pa.bool_()))
    return run


def drop_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with their own columns."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_clean(model, threshold, docs.columns.index(text_col)), docs.schema)
