"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: White space of the contracts, for ``trim`` and for patterns.
SPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT *, translate(trim(line, {SPACE}), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.doc_id, k.line, k.pos, coalesce(f.first_id < k.doc_id, false) AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

OP5 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(CASE WHEN len(ws) >= 3 THEN range(1, len(ws) - 1) WHEN len(ws) > 0 THEN [1] ELSE [] END) AS i FROM w),
g AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 2) AS shingle FROM i),
n AS (SELECT w.doc_id, count(g.shingle) AS n_shingles FROM w LEFT JOIN g ON g.doc_id = w.doc_id GROUP BY w.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM g x JOIN g y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n_shingles + y.n_shingles - common)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b)
SELECT n.doc_id, n.n_shingles, least(n.doc_id, coalesce(min(r.b), n.doc_id)) AS component_id
FROM n LEFT JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n_shingles"""

OP9 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
v AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM r, unnest([0, 1, 2, 3, 4]) t(o) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
c AS (SELECT d.doc_id, d.source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n_dup_lines, 0) AS n_dup_lines,
             coalesce(v.n_repeat_words, 0) AS n_repeat_words
      FROM d LEFT JOIN v ON v.doc_id = d.doc_id LEFT JOIN l ON l.doc_id = d.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
e AS (SELECT source, unnest([n_words < 10, 100 * n_repeat_words > 10 * n_words, 100 * n_symbols > 10 * n_words, n_dup_lines >= 3]) AS failed,
             unnest(['words', 'repeats', 'symbols', 'lines']) AS rule FROM b WHERE source IS NOT NULL),
h AS (SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE failed) AS f FROM e GROUP BY source, rule),
q AS (SELECT rule, sum(n) AS docs, count(*) AS hosts, sum(f) / sum(n) AS m, sum(f * f / n) AS squares FROM h GROUP BY rule),
a AS (SELECT rule, m, squares / docs - m * m - m * (1 - m) * hosts / docs AS spread FROM q),
s AS (SELECT rule, m, CASE WHEN spread > 1e-12 THEN greatest(least(m * (1 - m) / spread - 1, 1e4), 1.0) ELSE 1e4 END AS strength FROM a),
z AS (SELECT source, f, m, n + strength AS total, (f + m * strength) / (n + strength) AS rate FROM h JOIN s ON s.rule = h.rule),
t AS (SELECT source, bool_or(f > 0 AND (rate - 2 * sqrt(rate * (1 - rate) / (total + 1)) >= 1.5 * m OR rate >= 0.5)) AS bad FROM z GROUP BY source)
SELECT b.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(bad, false) AND (100 * n_repeat_words > 10 * n_words OR 100 * n_symbols > 10 * n_words OR n_dup_lines >= 3)) AS kept
FROM b LEFT JOIN t ON t.source = b.source"""

OP10 = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to FROM m"""

OP11 = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS key
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS nth FROM g),
c AS (SELECT DISTINCT doc_id, i + o AS i FROM r, range(20) t(o) WHERE nth > 1),
k AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
m AS (SELECT k.doc_id, string_agg(word, ' ' ORDER BY k.i) FILTER (WHERE c.i IS NULL) AS kept, count(c.i) AS n_removed
      FROM k LEFT JOIN c ON c.doc_id = k.doc_id AND c.i = k.i GROUP BY k.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN m ON m.doc_id = w.doc_id"""

#: CRC-32 of the decimal id, bit by bit: each byte is taken in, then shifted
#: out in eight steps (-1).
CRC = """xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END) END, CAST(4294967295 AS BIGINT)), 4294967295)"""

OP13 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT *, sha256(strlen(role) || ':' || role || text) AS token FROM t),
o AS (SELECT conv_id, token, strlen(text) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS pos FROM s),
i AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
n AS (SELECT conv_id, count(*) AS own FROM o GROUP BY conv_id),
b AS (SELECT i.conv_id, o.pos, o.token, o.bytes FROM i JOIN o ON o.conv_id = i.base AND o.pos <= i.h
      UNION ALL
      SELECT o.conv_id, least(i.h, coalesce(n.own, 0)) + o.pos - i.h, o.token, o.bytes
      FROM o JOIN i ON i.conv_id = o.conv_id LEFT JOIN n ON n.conv_id = i.base WHERE o.pos > i.h),
p AS (SELECT conv_id, pos, bytes, string_agg(token, ',') OVER (PARTITION BY conv_id ORDER BY pos) AS path, count(*) OVER (PARTITION BY conv_id) AS size FROM b
      UNION ALL
      SELECT i.conv_id, 0, 0, '', coalesce(m.size, 0) FROM i LEFT JOIN (SELECT conv_id, count(*) AS size FROM b GROUP BY conv_id) m ON m.conv_id = i.conv_id),
v AS (SELECT path, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = pos), '')) AS ends_sha256
      FROM p GROUP BY path, pos),
u AS (SELECT v.*, a.path AS parent, w.conv_id AS parent_conv_id
      FROM v LEFT JOIN p a ON a.conv_id = v.conv_id AND a.pos = v.depth - 1 LEFT JOIN v w ON w.path = a.path),
c AS (SELECT parent AS path, count(*) AS n_children FROM u GROUP BY parent),
x AS (SELECT a.path, count(*) FILTER (WHERE c.path IS NULL) AS n_leaves, sum((v.n_convs - 1) * v.bytes) AS saved_tokens
      FROM v JOIN p a ON a.conv_id = v.conv_id AND a.pos <= v.depth LEFT JOIN c ON c.path = v.path GROUP BY a.path)
SELECT u.conv_id, CAST(u.depth AS BIGINT) AS depth, u.parent_conv_id, u.n_convs, CAST(coalesce(c.n_children, 0) AS BIGINT) AS n_children,
       CAST(x.n_leaves AS BIGINT) AS n_leaves, CAST(x.saved_tokens AS BIGINT) AS saved_tokens, u.ends_sha256
FROM u LEFT JOIN c ON c.path = u.path JOIN x ON x.path = u.path"""

ORACLE_SQL = {
    "op2_line_dedup": OP2,
    "op5_jaccard": OP5,
    "op9_host_rules": OP9,
    "op10_warc": OP10,
    "op11_super_kmers": OP11,
    "op13_prefix_trie": OP13,
}
