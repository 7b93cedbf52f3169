"""Very long words, repeated queries, damaged archives, slices, and the whole pipeline against plain rules."""

import collections
import os
import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from rollbook.llm import near_dedup, queries, topk_search, toxicity, warc_store  # noqa: E402
from rollbook.llm.common import shared_path, slices  # noqa: E402


def plain_sets(rows, n):
    """Distinct n-word shingles of each (id, text)."""
    out = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        k = min(n, len(w))
        out[i] = {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if w else set()
    return out


def plain_components(sets, percent=80):
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() if len(h) < 400 for a in h for b in h if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            group[y] = x
    return {i: top(i) for i in sets}


def test_a_word_of_several_pieces_is_one_word(spark):
    long = "q" * (5 << 20)
    docs = spark.createDataFrame([(1, f"one two {long}"), (2, f"one  two\n{long.upper()}"), (3, f"one two {long}q"), (4, long)],
                                 "doc_id long, text string")
    got = {r.id: (r.n, r.component_id) for r in near_dedup.near_groups(docs, shingle=2).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 3), 4: (1, 4)}


def test_groups_below_the_threshold_stay_apart(spark):
    """Many texts that resemble each other just too little, with some that do not: equal to all pairs."""
    r = np.random.default_rng(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for j in r.choice(60, 6 if i % 3 else 2, replace=False):
            words[j] = f"x{r.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.id: x.component_id for x in near_dedup.near_groups(docs, shingle=2).collect()}
    assert got == plain_components(plain_sets(rows, 2)) and len(set(got.values())) > 20


def test_texts_are_filtered_or_shuffled_alike(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = sorted(map(tuple, near_dedup.near_groups(docs).select("id", "n", "component_id").collect()))
    monkeypatch.setattr(near_dedup, "BROADCAST_NODES", 0)
    assert sorted(map(tuple, near_dedup.near_groups(docs).select("id", "n", "component_id").collect())) == a


def test_every_query_row_is_asked(spark):
    rows = [(0, [0.1, 0.2]), (0, [0.3, -0.2]), (1, [0.5, 0.5]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 0.0]), (None, [9.0, 9.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk_search.top_k(d, d.filter("vec_id = 0"), k=10).collect()))
    want = []
    q = {i: np.floor(1024 * np.array(v, dtype=np.float32).astype(float)) for i, (_, v) in enumerate(rows[:4])}
    for a in (0, 1):
        ranked = sorted((-int(q[a] @ q[b]), rows[b][0]) for b in (2, 3))
        want += [(0, r + 1, v, -s) for r, (s, v) in enumerate(ranked)]
    assert got == sorted(want) and len(got) == 4


def test_blocks_of_queries_and_candidates(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=20 if i % 7 else 9)]) for i in range(500)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    ask = d.filter("vec_id % 20 = 0")
    monkeypatch.setattr(topk_search, "QUERIES_AT_ONCE", 6)
    got = sorted(map(tuple, topk_search.top_k(d, ask, k=5).collect()))
    v = np.zeros((500, 20))
    for i, x in rows:
        v[i, :len(x)] = np.floor(1024 * np.array(x))
    want = []
    for a in range(0, 500, 20):
        s = (v @ v[a]).astype(int)
        want += [(a, n + 1, b, int(s[b])) for n, b in enumerate(sorted((b for b in range(500) if b != a), key=lambda b: (-s[b], b))[:5])]
    assert got == sorted(want)


def test_finer_bounds_leave_fewer(monkeypatch):
    """Exact products are formed for survivors of the bounds only."""
    r = np.random.default_rng(5)
    c = np.round(r.normal(size=(2000, 64)).cumsum(axis=1) * 50).astype("int64")
    tried = []
    monkeypatch.setattr(topk_search, "_exact", lambda q, x, f=topk_search._exact: (tried.append(len(x)), f(q, x))[1])
    s = topk_search.Search([0, 1, 2], [0, 1, 2], c[:3].tolist(), 10)
    for a in range(0, 2000, 250):
        s.block(np.arange(a, a + 250), c[a:a + 250])
    for i in range(3):
        p = c @ c[i]
        assert s.best[i] == sorted((-int(p[j]), j) for j in range(2000) if j != i)[:10]
    assert sum(tried) < 0.5 * 3 * 2000


def test_damaged_archives_fail(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, None, None), (None, "v", "x" * 3_000_000)], "page_id long, url string, html string")
    path = shared_path(spark, "warc")
    warc_store.write_archive(pages, path)
    good = warc_store.read_archive(spark, path)
    assert {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in good.collect()} == {
        (1, "response", None, 3), (2, "revisit", 1, 3), (3, "response", None, 0), (None, "response", None, 3_000_000)}
    assert all(bytes(r.record).startswith(b"WARC/1.1\r\n") and bytes(r.record).endswith(b"\r\n\r\n") for r in good.collect())
    records, payloads = (spark.read.parquet(f"{path}/{x}") for x in ("records", "payloads"))
    bad = {
        "length": (records.withColumn("header", F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "Content-Length: 3\r\n\r\n", "Content-Length: 3 \r\n\r\n"), "UTF-8")), payloads),
        "digest": (records.withColumn("header", F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "sha1:[A-Z]", "sha1:9"), "UTF-8")), payloads),
        "payload": (records, payloads.withColumn("payload", F.concat("payload", F.lit(b"!")))),
    }
    for name, (r, p) in bad.items():
        r.write.parquet(str(tmp_path / name / "records"))
        p.write.parquet(str(tmp_path / name / "payloads"))
        with pytest.raises(Exception, match="header says|does not match"):
            warc_store.read_archive(spark, str(tmp_path / name)).collect()
    warc_store.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc_store.read_archive(spark, str(tmp_path / "none")).count() == 0


def test_slices_cover_the_column():
    texts = ["a" * n for n in (3, 0, 50, 7, 7, 1000, 2)] + [None] * 3
    got = list(slices(pa.array(texts, pa.string()), rows=4, chars=20))
    assert [t for _, some in got for t in some] == texts and [a for a, _ in got] == [sum(len(s) for _, s in got[:i]) for i in range(len(got))]


# ---- the pipeline ------------------------------------------------------------------------------

def test_pipeline_against_plain_rules(spark, tmp_path, monkeypatch):
    """``run`` on a table with nulls, copies, near copies, toxic rows and repeated rows, stage by stage."""
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 400").collect()
    rows = [tuple(r) for r in base]
    some = [r for r in rows if r[1] and 200 < len(r[1].split()) < 2000][:6]
    at = 10_000
    for r in some:  # exact and near copies, blanks apart
        rows += [(at, r[1] + "\n", *r[2:]), (at + 1, r[1].replace(r[1].split()[100], "changed", 1), *r[2:])]
        at += 2
    rows += [(at, None, None, None, None), (at + 1, "", "en", "s", 0), (at + 2, " \n", "en", "s", 2), (at + 3, None, "en", None, 0), rows[5], rows[5]]
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    spark.createDataFrame(rows, base.schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    stored = {}
    monkeypatch.setattr(P, "written", lambda df, name, f=P.written: stored.setdefault(name, f(df, name)))
    pieces = P.run(spark, str(tmp_path)).collect()
    kept = {n: stored[n].collect() for n in ("toxicity", "exact_dedup", "near_dedup", "mixing")}
    as_rows = lambda rs: collections.Counter(map(tuple, rs))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    model = queries.toxicity_model(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    def score(t):  # noqa: E306
        words = sorted(set(toxicity.words_of(t or "")))
        return model.score(model.decide(words).tolist() if words else [])
    clean = [r for r in rows if score(r[1]) < toxicity.THRESHOLD]
    assert as_rows(kept["toxicity"]) == as_rows(clean) and len(rows) * 0.6 < len(clean) < len(rows)

    best = {}
    for r in kept["toxicity"]:
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        rank = (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, tuple(r))
    assert as_rows(kept["exact_dedup"]) == collections.Counter(r for _, r in best.values())

    texts = [(r.doc_id, r.text) for r in kept["exact_dedup"]]
    comp = plain_components(plain_sets(texts, 5))
    want = {r.doc_id for r in kept["exact_dedup"] if comp[r.doc_id] == r.doc_id}
    assert {r.doc_id for r in kept["near_dedup"]} == want and len(want) < len(texts)

    copies = collections.Counter(r.doc_id for r in kept["mixing"])
    assert set(copies) <= want and max(copies.values()) <= 3
    words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in kept["near_dedup"]}
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in copies.items()) - total) < 0.1 * total

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.vocabulary())
    tokens = {r.doc_id: len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in kept["near_dedup"]}
    packed = collections.Counter()
    for p in pieces:
        packed[p.doc_id] += p.length
    assert packed == {i: tokens[i] * n for i, n in copies.items()}
    assert os.path.exists(sf)
