"""DuckDB text of the queries that SQL can express on whole tables."""

_WORDS = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '')"
_FIVE = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"

#: CRC-32 of the decimal id (reflected polynomial 0xEDB88320, a fixed value), a bit at a time.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: CAST(z AS BIGINT))), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))))"""
_FIELD = "coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
_LEAF = " || ".join(_FIELD.format(c=c) for c in ("doc_id", "source", "lang", "{n}", "text"))

SQL: dict[str, str] = {
    "op2_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
""",
    "op7_decontaminate": f"""
WITH i AS (SELECT item_id, {_FIVE} AS s FROM (SELECT item_id, {_WORDS} AS w FROM benchmark)),
si AS (SELECT item_id, len(s) AS n_item, unnest(s) AS s FROM i),
d AS (SELECT doc_id, text, {_FIVE} AS s FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents)),
sd AS (SELECT doc_id, text, unnest(s) AS s FROM d)
SELECT doc_id, item_id, CAST(n_item AS INTEGER) AS n_item, CAST(count(*) AS INTEGER) AS n_shared,
       count(*) / n_item AS containment
FROM sd JOIN si USING (s)
GROUP BY doc_id, text, item_id, n_item
HAVING count(*) >= 0.75 * n_item
""",
    "op8_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN {_FIVE} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
s AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS shared
  FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM pairs WHERE 100 * shared >= 75 * (nx + ny - shared)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM reach AS r JOIN ways AS e ON r.b = e.x)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c.component_id
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) AS c USING (doc_id)
""",
    "op11_merkle": f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS r,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS m_chars FROM documents),
l AS (
  SELECT doc_id, lang, r, sha256({_LEAF.format(n="n_chars")}) AS leaf, sha256({_LEAF.format(n="m_chars")}) AS changed FROM d),
p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (
  SELECT lang, 0 AS lvl, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, leaf AS h FROM p
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, any_value(n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2),
s AS (
  SELECT lang, lvl AS top, h AS subroot, CAST(row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS BIGINT) AS g, CAST(count(*) OVER () AS BIGINT) AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, g AS pos, n, subroot AS h FROM s
  UNION ALL
  SELECT lvl + 1, pos // 2, any_value(n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lvl, pos // 2),
nodes AS (
  SELECT t.lang, t.lvl, t.pos, t.h, t.n FROM t WHERE t.n > 1
  UNION ALL
  SELECT s.lang, s.top + u.lvl, u.pos, u.h, u.n FROM u, s WHERE u.n > 1),
w AS (
  SELECT p.doc_id, p.leaf, s.lang, s.subroot, s.g, s.top, s.top + (SELECT max(lvl) FROM u) AS ends, 0 AS lvl,
         CASE WHEN s.top = 0 THEN s.g ELSE CAST(p.pos AS BIGINT) END AS pos, p.changed AS h, '' AS proof
  FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT w.doc_id, w.leaf, w.lang, w.subroot, w.g, w.top, w.ends, w.lvl + 1, CASE WHEN w.lvl + 1 = w.top THEN w.g ELSE w.pos // 2 END,
         sha256(CASE WHEN x.h IS NULL THEN w.h WHEN w.pos % 2 = 1 THEN x.h || w.h ELSE w.h || x.h END), w.proof || coalesce(x.h, '')
  FROM w LEFT JOIN nodes AS x ON x.lang IS NOT DISTINCT FROM w.lang AND x.lvl = w.lvl AND x.pos = xor(w.pos, 1)
  WHERE w.lvl < w.ends)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, w.h AS folded_root, w.h = root.h AS verified
FROM w, (SELECT h FROM u WHERE n = 1) AS root WHERE w.lvl = w.ends
""",
}
