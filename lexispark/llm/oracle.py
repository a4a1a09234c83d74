"""The same results as DuckDB SQL."""

from __future__ import annotations

from . import quality

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold(expr: str) -> str:
    return f"translate({expr}, '{UPPER}', '{UPPER.lower()}')"


def op8_warc() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS n, sha1(h) AS s FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY s) AS top FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest, CASE WHEN n >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND top <> page_id THEN top END AS refers_to FROM m"""


def op10_line_dedup() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS MATERIALIZED (SELECT doc_id, pos, line, {fold(f"trim(line, {blanks})")} AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, c.last IS NOT NULL AND c.last <> k.doc_id AS lost FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def op4_near_dup() -> str:
    words = "regexp_extract_all(" + fold("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM d),
items AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT r.a AS doc_id, len(any_value(s.s))::BIGINT AS n_shingles, min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM reach r JOIN sets s ON s.doc_id = r.a GROUP BY r.a"""


def op5_quality_rules() -> str:
    phrases = "|".join(p.decode() for p in quality.BOILERPLATE)
    r = quality.Rules()
    ends = "list_contains(['" + "','".join([*".!?:;,\"", "''", *")]}…”’»。！？"]) + "'], right(w[len(w)], 1))"

    def chars(expr: str, kind: str) -> str:
        return f"length(regexp_replace({expr}, '[^{kind}]', '', 'g'))"

    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
words AS MATERIALIZED (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
tri AS MATERIALIZED (SELECT doc_id, i, list_slice(w, i, i + 2) AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (SELECT doc_id, x FROM tri GROUP BY ALL HAVING count(*) >= 2),
covered AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS k FROM tri JOIN again USING (doc_id, x)) GROUP BY doc_id),
lines AS MATERIALIZED (
  SELECT doc_id, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS w
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE len(w) > 0 GROUP BY doc_id),
marks AS (
  SELECT doc_id, line, w, len(w) AS n, {chars('line', '#*$%&|<>')} AS symbols, {chars('line', '|<>')} AS bars, {chars('line', '!')} AS marks,
    {chars('line', 'A-Z')} AS upper, {chars('line', 'a-z')} AS lower FROM lines WHERE len(w) > 0),
lost AS (
  SELECT doc_id, sum(n) AS n FROM marks
  WHERE (symbols >= 4 AND symbols > {r.symbols} * n) OR (bars >= 2 AND bars > {r.bars} * n)
    OR (upper + lower >= 20 AND upper > {r.upper} * (upper + lower)) OR (marks >= 4 AND marks > {r.marks} * n)
    OR (n < {r.stub} AND NOT {ends}) OR (n <= {r.boilerplate} AND regexp_matches({fold('line')}, '{phrases}')) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    {chars('t', '#*$%&|<>')}::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.n, 0)::BIGINT AS n_lost_words
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_lost_words <= {r.lost} * n_words AS kept FROM judged"""


def op7_decontamination() -> str:
    words = "regexp_extract_all(" + fold("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS MATERIALIZED (
  SELECT doc_id, i, size, list_slice(w, i, i + size - 1) AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS MATERIALIZED (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows USING (win)),
covered AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(s.n, 0)::BIGINT AS n_items,
  sha256(coalesce(s.ids, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN items s USING (doc_id)"""


def op11_conversation_repair() -> str:
    """The repair as a shortest way through the states, turn by turn; at most two insertions in a row can pay."""
    return r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT) AS bytes FROM conversations),
coded AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS code FROM given, crc),
hurt AS (
  SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE code WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE code <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    left(role, 1) AS k, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM hurt),
faults AS MATERIALIZED (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(k) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || k NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY conv_id),
inserts(s, s2, c, w) AS (VALUES (0,0,0,''), (0,2,5,'I'), (0,3,10,'II'), (1,1,0,''), (1,2,5,'I'), (1,3,10,'II'), (2,2,0,''), (2,3,5,'I'), (3,3,0,''), (3,2,5,'I')),
acts(s, k, s2, c, w) AS (VALUES (0,'s',1,0,'K'), (0,'u',2,0,'K'), (1,'u',2,0,'K'), (3,'u',2,0,'K'), (2,'a',3,0,'K'),
  (0,'*',2,1,'R'), (1,'*',2,1,'R'), (3,'*',2,1,'R'), (2,'*',3,1,'R'), (0,'*',0,2,'D'), (1,'*',1,2,'D'), (2,'*',2,2,'D'), (3,'*',3,2,'D')),
steps AS MATERIALIZED (SELECT i.s, a.k, a.s2, i.c + a.c AS c, i.w || a.w AS w, a.w AS act FROM inserts i JOIN acts a ON a.s = i.s2),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'c': 0, 'w': ''} AS way FROM counts
  UNION ALL
  SELECT w.conv_id, w.i + 1, t.s2, min({'c': w.way.c + t.c + CASE WHEN f.fault = 't' AND t.act <> 'D' THEN 5 ELSE 0 END, 'w': w.way.w || t.w})
  FROM ways w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  JOIN steps t ON t.s = w.s AND t.k IN ('*', f.k) AND (t.act = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY w.conv_id, w.i, t.s2),
best AS (
  SELECT c.conv_id, min({'c': w.way.c + i.c, 'w': w.way.w || i.w}) AS way
  FROM counts c JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN inserts i ON i.s = w.s AND i.s2 IN (0, 3) GROUP BY c.conv_id),
letters AS (SELECT conv_id, way.w AS w, unnest(range(1, length(way.w) + 1)) AS p FROM best),
edits AS (
  SELECT conv_id, p, substr(w, p, 1) AS e, length(replace(left(w, p), 'I', '')) AS i, length(replace(left(w, p), 'D', '')) AS q FROM letters),
placed AS (
  SELECT e.conv_id, e.p, e.e, e.q, f.role, f.text, f.k,
    max(CASE WHEN e.q = 1 AND e.e = 'K' AND f.k = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS sys
  FROM edits e LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.e <> 'I' WHERE e.e <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (q - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS t
  FROM placed GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(b.way.c, 0)::BIGINT AS cost, coalesce(b.way.w, '') AS audit,
  sha256(coalesce(t.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id"""


def op13_hard_negatives() -> str:
    return """
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, n.id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n USING (anchor_id) WHERE NOT n.same AND 80 * positive_score <= 100 * n.score AND n.score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= 5"""


SQL = (op13_hard_negatives, op11_conversation_repair, op4_near_dup, op5_quality_rules, op7_decontamination, op8_warc, op10_line_dedup,)


def oracle_sql() -> dict[str, str]:
    return {f.__name__: f() for f in SQL}
