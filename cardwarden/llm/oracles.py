"""The same results in DuckDB's SQL, for the operators on conversations and n-gram sets."""

from __future__ import annotations


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, {crc32("CAST(c AS VARCHAR)")} % 6 AS h, list(struct_pack(role := role, text := text) ORDER BY i) AS own FROM turns GROUP BY c
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.own[1:a.h], []), a.own[a.h + 1:]) AS seq
  FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 100
), steps AS (
  SELECT c, CAST(d AS BIGINT) AS d, md5(CAST(seq[1:d] AS VARCHAR)) AS node, CASE WHEN d > 0 THEN md5(CAST(seq[1:d - 1] AS VARCHAR)) END AS above,
         CASE WHEN d > 0 THEN length(seq[d].text) ELSE 0 END AS size, len(seq) = d AS ends
  FROM rebuilt, unnest(range(len(seq) + 1)) AS r(d)
), nodes AS (
  SELECT node, d, min(c) AS conv_id, any_value(above) AS above, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY node, d
), kids AS (
  SELECT above AS node, d - 1 AS d, count(*) AS k FROM nodes WHERE above IS NOT NULL GROUP BY above, d
), full_ AS (
  SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN kids USING (node, d)
), under AS (
  SELECT a.node, a.d, sum(f.k = 0) AS n_leaves, sum((f.n - 1) * f.size) AS saved
  FROM full_ f JOIN steps s ON s.node = f.node AND s.d = f.d AND s.c = f.conv_id
  JOIN steps a ON a.c = s.c AND a.d <= s.d GROUP BY a.node, a.d
)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.k AS n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
       CAST(u.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_ f JOIN under u USING (node, d) LEFT JOIN nodes p ON p.node = f.above AND p.d = f.d - 1
"""

NGRAM_JOIN = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM split
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN sizes z ON z.doc_id = r.doc_id GROUP BY r.doc_id
"""

REPAIR = f"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("concat(CAST(conv_id AS VARCHAR), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS damage
  FROM conversations WHERE conv_id IS NOT NULL
), damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM named, unnest(range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(k)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, E' \\t\\n\\x0B\\f\\r') AS body
  FROM damaged
), repeated AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         concat(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i), left(role, 1)) NOT IN ('su', 'ua', 'au') AND i > 1 AS odd
  FROM repeated
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (odd) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
), step(st, r, st2, name) AS (
  VALUES ('e', 's', 's', NULL), ('e', 'u', 'u', 'user'), ('s', 'u', 'u', 'user'), ('a', 'u', 'u', 'user'), ('u', 'a', 'a', 'assistant')
), gap(st, st1, price, mark, added) AS (
  SELECT st, st2, 5, 'I', [name || ':'] FROM step WHERE name IS NOT NULL
  UNION ALL SELECT st, st, 0, '', CAST([] AS VARCHAR[]) FROM (VALUES ('e'), ('s'), ('u'), ('a')) v(st)
), edit(st1, st2, r, name, price, mark) AS (
  SELECT st, st2, r, NULL, 0, 'K' FROM step
  UNION ALL SELECT st, st2, NULL, name, 1, 'R' FROM step WHERE name IS NOT NULL
  UNION ALL SELECT st, st, NULL, NULL, 2, 'D' FROM (VALUES ('e'), ('s'), ('u'), ('a')) v(st)
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 'e' AS st, {{'cost': 0, 'audit': '', 'kept': CAST([] AS VARCHAR[])}} AS best FROM counted
  UNION ALL
  SELECT f.conv_id, f.i, e.st2, min({{
    'cost': CAST(w.best.cost + g.price + e.price + CASE WHEN e.mark <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS INTEGER),
    'audit': w.best.audit || g.mark || e.mark,
    'kept': w.best.kept || g.added || CASE WHEN e.mark = 'D' THEN CAST([] AS VARCHAR[]) ELSE [coalesce(e.name, f.role) || ':' || f.text] END}})
  FROM walk w JOIN faulty f ON f.conv_id = w.conv_id AND f.i = w.i + 1
  JOIN gap g ON g.st = w.st
  JOIN edit e ON e.st1 = g.st1 AND (e.mark = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (e.mark = 'R' OR e.r = left(f.role, 1)))
  GROUP BY f.conv_id, f.i, e.st2
), ended AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + g.price, 'audit': w.best.audit || g.mark, 'kept': w.best.kept || g.added}}) AS best
  FROM walk w JOIN counted c ON c.conv_id = w.conv_id AND c.n = w.i
  JOIN gap g ON g.st = w.st WHERE g.st1 IN ('e', 'a') GROUP BY w.conv_id
)
SELECT v.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL) v
LEFT JOIN counted USING (conv_id) LEFT JOIN ended USING (conv_id)
"""
