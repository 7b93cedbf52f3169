"""Quality rules, ranked search and the manifest against plain versions, with odd input."""

import collections
import hashlib
import math
import os
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from rollbook.llm import bitsliced_search, divergence, hashing, merkle, queries  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, g string, h string, leaf string, pos long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing extra columns."""
    r = np.random.default_rng(3)
    words = ["the", "of", "and", "Stone", "river", "ÉTÉ", "naïve", "x1", "#$%", "a|b", "end."]
    texts = [None, "", " \t\n", "one", "the of\nthe of\n\nthe of", " ".join(["the of and stone river so it goes"] * 30),
             " ".join(r.choice(words, 40_000)), "z" * 2_500_000 + " tail", "a\x00b\x7fc 　 d\xa0e"]
    texts += [" ".join(r.choice(words, n)) for n in r.integers(10, 120, 60)]
    rows = [(i, t, None if i % 9 == 0 else "en", None if i % 4 == 0 else f"s{'é' * (i % 3)}", i % 5 or None, 1, "g", "h", "l", 2)
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no id the of", None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- base rules ------------------------------------------------------------------------

def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered))


def test_counts_equal_plain_ones(odd):
    got = collections.Counter((r.id, *(r[c] for c in divergence.COUNTS), r.base_failed) for r in divergence.quality(odd).collect())
    want = collections.Counter()
    for r in odd.collect():
        n = plain_counts(r.text)
        want[(r.doc_id, *n, n[0] < 20 or 100 * n[4] > 30 * n[0])] += 1
    assert got == want


def plain_distance(counts, ref):
    p, q = [c / sum(counts) for c in counts], [c / sum(ref) for c in ref]
    kl = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b, strict=True) if x)
    return math.sqrt(max(0, (kl(p, q) + kl(q, p)) / 2 - (len(counts) - 1) / (8 * math.log(2) * sum(counts))))


def test_verdicts_equal_a_plain_version(spark):
    """Common words, medians, distances and guards by plain Python on a whole table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    bag = {r.doc_id: divergence.plain_words((r.text or "").encode()) for r in rows}
    held = collections.defaultdict(collections.Counter)
    for r in rows:
        if len(bag[r.doc_id]) >= divergence.MIN_WORDS:
            held[r.lang].update(set(bag[r.doc_id]))
    common = {g: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:divergence.COMMON]] for g, c in held.items()}

    def char_hist(text):
        out = [0] * divergence.CLASSES
        for ch in text or "":
            out[int(divergence._CLASS[ch.encode()[0]])] += 1
        return out

    def word_hist(r):
        c = collections.Counter(bag[r.doc_id])
        hits = [c[w] for w in common.get(r.lang, [])]
        return [*hits, len(bag[r.doc_id]) - sum(hits)] if hits else []

    feats = {r.doc_id: (r.lang, plain_counts(r.text), char_hist(r.text), word_hist(r)) for r in rows}
    bad = {i: n[0] < 20 or 100 * n[4] > 30 * n[0] for i, (_, n, _, _) in feats.items()}

    def median(hists):
        if len(hists) < divergence.MIN_DOCUMENTS:
            return None
        cols = zip(*[[x * divergence.STEPS // sum(h) for x in h] for h in hists], strict=True)
        return [sorted(c)[-(-len(c) // 2) - 1] for c in cols]

    langs = {f[0] for f in feats.values()}
    once = {(r.lang, r.text): r.doc_id for r in rows}.values()
    usable = [(feats[i][0], feats[i][2]) for i in once if not bad[i] and sum(feats[i][2]) >= divergence.MIN_CHARS]
    every = median([h for _, h in usable])
    chars = {g: median([h for x, h in usable if x == g]) for g in langs}
    words = {g: median([feats[i][3] for i in once if feats[i][0] == g and not bad[i] and feats[i][1][0] >= divergence.MIN_WORDS]) for g in langs}
    got = {r.id: r for r in divergence.quality(docs).collect()}
    assert len(got) == len(rows)
    judged = 0
    for i, (g, n, c, w) in feats.items():
        a = plain_distance(c, chars[g] or every) if sum(c) >= divergence.MIN_CHARS and (chars[g] or every) else None
        b = plain_distance(w, words[g]) if n[0] >= divergence.MIN_WORDS and w and words[g] and chars[g] else None
        for mine, plain in ((got[i].char_distance, a), (got[i].word_distance, b)):
            assert (mine is None) == (plain is None)
            assert mine is None or mine == pytest.approx(plain, abs=1e-9)
        judged += b is not None
        assert got[i].kept == (not bad[i] and (a is None or a <= divergence.MAX_CHARS) and (b is None or b <= divergence.MAX_WORDS))
    assert judged > 50


def test_junk_goes_and_clean_stays(spark):
    sf = "/root/testdata/sf0.01"
    q = queries.op11_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.k for r in q.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[1] >= 0.95 and share[0] <= 0.15


def test_hot_copies_do_not_bend_the_reference(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    one = docs.filter("length(text) > 2000 and lang = 'fr'").limit(1).select(F.col("text").alias("hot"))
    hot = spark.range(450).select((F.col("id") + 100_000).alias("doc_id"), F.lit("en").alias("lang")).join(one).select(
        "doc_id", F.col("hot").alias("text"), "lang")
    before = {r.id: r.kept for r in divergence.quality(docs).collect()}
    after = {r.id: r.kept for r in divergence.quality(docs.unionByName(hot)).collect()}
    changed = [i for i in before if before[i] != after[i]]
    assert len(changed) <= 0.02 * len(before)


# ---- search ----------------------------------------------------------------------------

def plain_search(docs, items, k=10):
    bags = [(i, collections.Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))))
            for i, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked = collections.Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scored = []
        for i, b in bags:
            m = 25 + (75 * sum(b.values()) * n_docs) // total if total else 0
            s = sum(o * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t, o in asked.items() if b[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


def test_search_equals_a_plain_one(spark, odd, empty, monkeypatch):
    items = spark.createDataFrame([(1, "the River été"), (2, "tail of " + "z" * 2_500_000), (3, None), (4, ""), (5, "x1 x1 one b c"),
                                   (6, "nowhere"), (None, "stone")], "item_id long, text string")
    want = plain_search([(r.doc_id, r.text) for r in odd.collect()], [tuple(r) for r in items.collect()])
    monkeypatch.setattr(bitsliced_search, "GATHERED", 500)  # many blocks
    assert sorted(map(tuple, bitsliced_search.search(odd, items).collect()), key=str) == want
    assert bitsliced_search.search(empty, items).count() == 0 and bitsliced_search.search(odd, items.limit(0)).count() == 0
    monkeypatch.setattr(bitsliced_search, "QUERIES_AT_ONCE", 2)
    monkeypatch.setattr(bitsliced_search, "BROADCAST_KEYS", 0)
    assert sorted(map(tuple, bitsliced_search.search(odd, items).collect()), key=str) == want


def test_bounds_hold_and_exclude(spark):
    """No document scores above its bound, and most documents are never rescored."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = bitsliced_search.build_index(docs)
    blocks = [r.asDict() for r in index.filter("width is not null").collect()]
    q = bitsliced_search.Queries.of(items)
    q.documents, q.total = sum(len(b["ids"]) for b in blocks), sum(sum(b["sizes"]) for b in blocks)
    df = bitsliced_search._frequencies(index, q)
    q.weights = np.array([bitsliced_search.weight(df.get(int(h), 0), q.documents) for h in q.hashes.view(np.int64)])
    exact = {(i, d): s for i, _, d, s in plain_search([(r.doc_id, r.text) for r in docs.collect()], items, k=10**6)}
    floor = {}
    for (i, _), s in exact.items():
        floor.setdefault(i, []).append(s)
    seen, reach = 0, 0
    for b in blocks:
        for j, bound in bitsliced_search._bounds(q, b):
            for d, x in zip(b["ids"], bound, strict=True):
                s = exact.get((q.items[j], d), 0)
                assert s <= x
                seen += 1
                reach += x >= sorted(floor[q.items[j]])[-10]
    assert seen and reach < 0.3 * seen


def test_long_runs_hash_as_one():
    inside = np.array([b > 32 for b in range(256)])
    text = "ab " + "q" * (3 * hashing.CHUNK + 17) + " cd" + "é" * hashing.CHUNK
    got = next(hashing.run_hashes([text], inside))
    short = [next(hashing.run_hashes([w], inside))[0] for w in ("ab",)]
    assert len(got) == 3 and got[0] == short[0]
    assert got[1] == next(hashing.run_hashes(["x" * 5 + " " + text[3:-3 - hashing.CHUNK]], inside))[1]


# ---- manifest --------------------------------------------------------------------------

def h(*x):
    return hashlib.sha256("".join(x).encode()).hexdigest()


def plain_leaf(r, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, pos):
    for a in tree[:-1]:
        b = pos // 16 * 16
        yield a[b:pos], a[pos + 1:b + 16]
        pos //= 16


def plain_manifest(rows, claim):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, plain_leaf(r, r.text)))
        trees[s] = levels([plain_leaf(r, r.text) for r in by[s]])
    top = levels([trees[s][-1][0] for s in names])
    for j, s in enumerate(names):
        for i, r in enumerate(by[s]):
            p = [*siblings(trees[s], i), *siblings(top, j)]
            x = claim(r)
            for a, b in p:
                x = h(*a, x, *b)
            yield (r.doc_id, plain_leaf(r, r.text), trees[s][-1][0], top[-1][0], h(*[y for a, b in p for y in a + b]), x)


def claimed(r):
    low = r.text and r.text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
    return plain_leaf(r, low if hit else r.text)


def test_manifest_equals_a_plain_one(spark, odd, empty, tmp_path):
    for name, docs in (("odd", odd), ("lone", odd.filter("doc_id = 10"))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        got = queries.op13_manifest(spark, str(tmp_path / name)).collect()
        want = [(*x, x[5] == x[3]) for x in plain_manifest(docs.collect(), claimed)]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.op13_manifest(spark, str(tmp_path / "none")).count() == 0


def test_manifest_of_many_blocks(spark):
    """A hot source of more than one block, and more sources than one run holds."""
    n = merkle.BLOCK * 2 + 33
    rows = spark.range(n + 40).select(
        F.col("id"), F.when(F.col("id") < n, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("source"),
        F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    got = {r.id: r for r in merkle.manifest(rows.withColumn("claim", F.col("leaf"))).collect()}
    leaf = lambda i: h(str(i))
    hot = levels([leaf(i) for i in range(n)])
    names = ["hot", *[f"s{i}" for i in range(n, n + 40)]]
    top = levels([hot[-1][0], *[leaf(i) for i in range(n, n + 40)]])
    for i in [0, 15, 16, 4095, 4096, n - 34, n - 1, n, n + 39]:
        p = [*siblings(hot, i)] if i < n else []
        p += siblings(top, names.index("hot" if i < n else f"s{i}"))
        assert got[i].subroot == (hot[-1][0] if i < n else leaf(i)) and got[i].proof == h(*[y for a, b in p for y in a + b])
    assert all(r.folded == r.root == top[-1][0] for r in got.values()) and len(got) == n + 40


def test_tampering_of_the_leaf_shows(spark):
    rows = spark.range(50).select("id", F.lit("s").alias("source"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    bad = rows.withColumn("claim", F.when(F.col("id") == 7, F.sha2(F.lit("x"), 256)).otherwise(F.col("leaf")))
    assert [r.id for r in merkle.manifest(bad).collect() if r.folded != r.root] == [7]
