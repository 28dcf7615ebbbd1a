"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

# SHA-1 in base 32: five hexadecimal digits hold four digits of five bits.
_BASE32 = """
array_to_string([
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + (('0x' || sha[5 * (i // 4) + 1 : 5 * (i // 4) + 5])::BIGINT >> (15 - 5 * (i % 4))) % 32]
  for i in range(32)], '')
"""

WEB_ARCHIVE = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY sha) AS keeper FROM p
)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""

REPLY_TREES = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, regexp_replace(regexp_replace(text, '(\\*)### ', '\\\1### ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g') AS escaped FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       sum(length('### ' || role || chr(10)) + length(escaped) + length('</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

SHINGLE_JOIN = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), o AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT x, y FROM o JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 75 * (nx.n + ny.n - shared)
), e AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x
)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

FILTER_AUDIT = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), f AS (
  SELECT doc_id, part, len(ws) < 200 AS fa, 100 * len(list_distinct(ws)) < 50 * len(ws) AS fb,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS fc,
         regexp_matches(text, '[#$%&*|]') AS fd,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS fe
  FROM w
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT f.part, f.fa, f.fb, f.fc, f.fd, f.fe, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM f LEFT JOIN l ON l.doc_id = f.doc_id
), c AS (
  SELECT part, fa::INT + 2 * fb::INT + 4 * fc::INT + 8 * fd::INT + 16 * fe::INT AS cell,
         count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM d GROUP BY ALL
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
  SELECT filter_order, k AS step, bits[k] AS own, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before FROM o, range(1, 6) r(k)
), g AS (
  SELECT c.part, s.filter_order, s.step, s.own,
         coalesce(sum(n) FILTER (cell & (before | own) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (cell & own > 0 AND cell & before = 0), 0) AS removed,
         coalesce(sum(n) FILTER (cell & own > 0 AND cell & before > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (cell = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (cell & own > 0 AND cell & before = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (cell & own > 0 AND cell & before = 0), 0) AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM g
"""

DIGEST_MERGE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS normal FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY normal) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(normal) AS text_sha256
FROM n WINDOW best AS (PARTITION BY normal ORDER BY chars DESC, doc_id NULLS LAST)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_reply_trees": REPLY_TREES, "op9_shingle_join": SHINGLE_JOIN, "op10_web_archive": WEB_ARCHIVE, "op11_filter_audit": FILTER_AUDIT, "op13_digest_merge": DIGEST_MERGE}
