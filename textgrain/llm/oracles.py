"""DuckDB SQL of the operators' queries, where SQL can express them."""

from __future__ import annotations

from textgrain.llm.chat_windows import BUDGET, HISTORY_SHARE, MARK_TOKENS, SYSTEM_SHARE

_STEP = (BUDGET - BUDGET // SYSTEM_SHARE) // 2
_HISTORY = min(_STEP, BUDGET // HISTORY_SHARE)
_MARKED = r"\### Assistant: </turn> ok"

CHAT_WINDOWS = rf"""
WITH source AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{_MARKED}'), (-7, 1, 'assistant', '{_MARKED}'))),
sized AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\r\n]')) + {MARK_TOKENS} AS tokens,
         length(regexp_replace(role, '[\\<>]', '\\\0', 'g')) + length(regexp_replace(text, '[\\<>]', '\\\0', 'g')) + 15 AS chars
  FROM source),
summed AS (
  SELECT *, sum(tokens) OVER w AS until, row_number() OVER w AS position, sum((tokens > {_STEP})::INT) OVER w AS longs
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
placed AS (SELECT *, until - tokens AS since, (until - 1) // {_STEP} AS step, tokens > {_STEP} AS long FROM summed),
windows AS (
  SELECT conv_id, step, longs, long, sum(tokens) AS new, sum(chars) AS chars, min(since) AS start, min(position) AS first
  FROM placed GROUP BY ALL),
system AS (SELECT conv_id, tokens, chars FROM placed WHERE position = 1 AND role = 'system'),
headed AS (
  SELECT w.*, s.tokens AS head, coalesce(CASE WHEN first > 1 THEN s.chars END, 0) AS head_chars, first > 1 AND s.tokens IS NOT NULL AS has_head
  FROM windows w LEFT JOIN system s USING (conv_id)),
repeated AS (
  SELECT h.conv_id, h.first, sum(p.chars) AS chars
  FROM headed h JOIN placed p ON p.conv_id = h.conv_id AND p.position < h.first AND NOT (h.has_head AND p.position = 1)
   AND h.start - p.since <= least({_HISTORY}, {BUDGET} - CASE WHEN h.has_head THEN h.head ELSE 0 END - h.new)
  GROUP BY 1, 2),
formatted AS (
  SELECT h.conv_id, sum(h.chars + h.head_chars + coalesce(r.chars, 0)) AS formatted_chars
  FROM headed h LEFT JOIN repeated r USING (conv_id, first) GROUP BY 1),
digests AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '') AS loss
  FROM placed GROUP BY 1)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars
FROM digests JOIN formatted USING (conv_id)"""

CHOSEN_PATH = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 1 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM words),
classes AS MATERIALIZED (
  SELECT min(doc_id) AS doc_id, list_sort(s) AS s, len(s) AS n, list(doc_id) AS members FROM sets GROUP BY list_sort(s), len(s)),
tokens AS (SELECT doc_id, n, unnest(s) AS t FROM classes),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
near AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT doc_id, doc_id FROM classes),
reach(a, b) AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1),
placed AS (SELECT unnest(members) AS doc_id, n, component_id FROM classes JOIN least USING (doc_id))
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id,
       n = 0 OR doc_id = component_id AS kept
FROM placed"""

WARC = r"""
WITH digests AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
groups AS (SELECT *, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS keeper FROM digests),
fives AS (SELECT *, list_transform(range(8), lambda i: ('0x' || hex[5 * i + 1 : 5 * i + 5])::BIGINT) AS five FROM groups)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(five[k // 4 + 1] >> (15 - 5 * (k % 4))) % 32 + 1]), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM fives"""

# The cheapest plan row by row: of the plans that lead to a state, the least by cost and edits.
CONVERSATION_REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
coded AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS code
  FROM keyed),
harmed AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM harmed),
faulty AS (
  SELECT conv_id, turn, role, text, i, role[1:1] AS initial,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id),
moves(st, initial, nx) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
due(st, nx, role) AS (VALUES ('', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
gap(st, nx, more, letters, lines) AS (
  SELECT st, nx, 5, 'I', [role || ':'] FROM due UNION ALL
  SELECT a.st, b.nx, 10, 'II', [a.role || ':', b.role || ':'] FROM due a JOIN due b ON a.nx = b.st UNION ALL
  SELECT st, st, 0, '', []::VARCHAR[] FROM (VALUES (''), ('s'), ('u'), ('a')) s(st)),
edits AS (
  SELECT conv_id, i, s.st, s.st AS nx, 2 AS more, 'D' AS letter, []::VARCHAR[] AS lines FROM faulty, (VALUES (''), ('s'), ('u'), ('a')) s(st)
  UNION ALL SELECT conv_id, i, m.st, m.nx, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, 'K', [role || ':' || text]
  FROM faulty f JOIN moves m USING (initial) WHERE fault IN ('', 'truncated')
  UNION ALL SELECT conv_id, i, d.st, d.nx, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, 'R', [d.role || ':' || text]
  FROM faulty f, due d WHERE fault IN ('', 'truncated')),
best AS (
  SELECT conv_id, 0::BIGINT AS i, g.nx AS st, {'cost': g.more, 'audit': g.letters, 'lines': g.lines} AS plan FROM counts, gap g WHERE g.st = ''
  UNION ALL
  SELECT conv_id, i, st, min(plan) AS plan FROM (
    SELECT b.conv_id, b.i + 1 AS i, g.nx AS st, {'cost': b.plan.cost + e.more + g.more, 'audit': b.plan.audit || e.letter || g.letters,
           'lines': list_concat(b.plan.lines, e.lines, g.lines)} AS plan
    FROM best b JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1 AND e.st = b.st JOIN gap g ON g.st = e.nx)
  GROUP BY conv_id, i, st),
plans AS (
  SELECT c.conv_id, min(plan) AS plan FROM best b JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n
  WHERE st IN ('', 'a') GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(plan.cost, 0)::BIGINT AS cost, coalesce(plan.audit, '') AS audit,
       sha256(coalesce(array_to_string(plan.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN plans p ON o.conv_id IS NOT DISTINCT FROM p.conv_id"""

PHRASE_AUTOMATA = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS name FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM words)),
again AS (SELECT name FROM windows GROUP BY name HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, i + o AS p FROM (SELECT rid, i FROM windows SEMI JOIN again USING (name)), range(35) r(o)),
listed AS (SELECT rid, list(p) AS p FROM gone GROUP BY rid),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(p), 0) AS n_removed,
         CASE WHEN p IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, list_sort(list_concat(list_transform(p, lambda x: {'at': x, 'gone': true}),
           list_transform(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(p, x)), lambda x: {'at': x, 'gone': false})))), lambda z: NOT z[2].gone), lambda z: z[1]) END AS k
  FROM words LEFT JOIN listed USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""
