"""DuckDB SQL for the queries that SQL can express."""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((('0x' || substr(h, 5 * i + 1, 5))::BIGINT >> {}) & 31 as BIGINT) + 1, 1)"
_DIGITS = " || ".join(_DIGIT.format(shift) for shift in (15, 10, 5, 0))

_TERMS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: CRC-32 of a decimal, bit by bit.
_CRC_BIT = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
_CRC = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')]), "
        f"lambda s, b: list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {_CRC_BIT})))")
#: Levels of the tree of a source, and of the tree of the sources, that the SQL spells out: 16**5 nodes.
_LEVELS = 5


def _leaf(text: str) -> str:
    part = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    return "sha256(" + " || ".join(part.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(start: str, name: str) -> str:
    """CTEs of the levels of trees: ``start`` has g, pos, h, n; ``name``<l> has the siblings' digests too."""
    out = []
    for level in range(_LEVELS):
        run = "PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN"
        out.append(f"""{name}{level} AS (
  SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {start})""")
        start = f"{name}up{level}"
        out.append(f"""{start} AS (
  SELECT g, pos // 16 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
         (n + 15) // 16 AS n FROM {name}{level} GROUP BY g, pos // 16, n)""")
    return ",\n".join(out)


def _fold(name: str, join: str) -> str:
    """CTEs that climb the levels of a tree from f (g, pos, x, p): x is folded, p gets the siblings."""
    out = []
    for level in range(_LEVELS):
        out.append(f"""{name}f{level} AS (
  SELECT f.* REPLACE (f.pos // 16 AS pos, CASE WHEN t.n > 1 THEN sha256(t.l || f.x || t.r) ELSE f.x END AS x,
         CASE WHEN t.n > 1 THEN f.p || t.l || t.r ELSE f.p END AS p)
  FROM {join if level == 0 else f"{name}f{level - 1}"} f JOIN {name}{level} t ON t.g = f.g AND t.pos = f.pos)""")
    return ",\n".join(out)


_MANIFEST = f"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS g, {_leaf("text")} AS h,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS bad
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
start AS (SELECT g, pos, h, n FROM leaves),
{_tree("start", "s")},
subroots AS (SELECT u.g, u.h AS subroot, row_number() OVER (ORDER BY m.source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
             FROM sup{_LEVELS - 1} u JOIN (SELECT DISTINCT g, source FROM d) m ON m.g = u.g),
tops AS (SELECT '' AS g, place AS pos, subroot AS h, n FROM subroots),
{_tree("tops", "t")},
claims AS (SELECT doc_id, h AS leaf, g, pos, coalesce(bad, h) AS x, '' AS p FROM leaves),
{_fold("s", "claims")},
second AS (SELECT f.doc_id, f.leaf, '' AS g, u.place AS pos, f.x, f.p, u.subroot FROM sf{_LEVELS - 1} f JOIN subroots u ON u.g = f.g),
{_fold("t", "second")}
SELECT f.doc_id, f.leaf, f.subroot, u.h AS root, sha256(f.p) AS proof_sha256, f.x AS folded_root, f.x = u.h AS verified
FROM tf{_LEVELS - 1} f, tup{_LEVELS - 1} u"""

SQL = {
    "op5_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first_page FROM p)
SELECT page_id, cast(n AS BIGINT) AS payload_bytes,
       array_to_string([{_DIGITS} FOR i IN range(8)], '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM d""",
    "op7_topk": """
WITH e AS (
  SELECT vec_id, [floor(1024 * cast(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
),
k AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM k""",
    "op12_lexical_search": f"""
WITH d AS (SELECT doc_id, {_TERMS.format("text")} AS terms FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d),
tf AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM e GROUP BY doc_id, term),
st AS (SELECT count(*)::BIGINT AS docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), st),
q AS (SELECT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark WHERE text IS NOT NULL),
qt AS (SELECT item_id, term, count(*) AS often FROM q GROUP BY item_id, term),
s AS (SELECT item_id, doc_id,
             sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
      FROM qt JOIN w USING (term) JOIN tf USING (term), st GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op13_manifest": _MANIFEST,
}
