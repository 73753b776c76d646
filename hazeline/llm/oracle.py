"""SQL for the queries that SQL can express."""

from __future__ import annotations

_TEXT = "coalesce(text, '')"

EXACT_COPIES = f"""
WITH n AS (
  SELECT doc_id, regexp_replace({_TEXT}, '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

BENCHMARK_OVERLAP = f"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), i AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2),
         lambda k: array_to_string(w[k : k + least(10, len(w)) - 1], ' '))) AS g
  FROM i WHERE len(w) > 0
), dw AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, unnest(list_transform(range(1, len(w) - n + 2),
         lambda k: array_to_string(w[k : k + n - 1], ' '))) AS g
  FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n
), hit AS (
  SELECT DISTINCT doc_id, dw.n, p, item_id FROM dw JOIN iw ON iw.n = dw.n AND iw.g = dw.g
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_ESCAPED = (
    "replace(replace(replace(replace(replace({}, '%', '%25'), '<s>', '%3Cs>'), '</s>', '%3C/s>'),"
    " '[INST]', '%5BINST]'), '[/INST]', '%5B/INST]')"
)

CHAT_TURNS = f"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c
), a AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('<s>[INST][/INST]</s>') + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) AS formatted_chars
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars
FROM a
"""

_SPACED = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

SKETCHED_COPIES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_SPACED.format(_LOWER)} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - least(3, len(w)) + 2),
         lambda k: array_to_string(w[k : k + least(3, len(w)) - 1], ' '))) AS g
  FROM d WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

# CRC-32 of the decimal id, bit by bit (fixed values: the polynomial 0xEDB88320, start and end 0xFFFFFFFF)
_CRC = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
       lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))"""

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT conv_id, count(*) AS n, {_CRC} % 4 AS h FROM t GROUP BY conv_id
), c AS (
  SELECT n.conv_id, n.conv_id - n.conv_id % 20 AS base, n.h, least(n.h, coalesce(b.n, 0)) AS taken
  FROM n LEFT JOIN n b ON b.conv_id = n.conv_id - n.conv_id % 20
), r AS (
  SELECT conv_id, i - h + taken AS d, role, text FROM t JOIN c USING (conv_id) WHERE i > h
  UNION ALL SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.base WHERE i <= taken
), p AS (
  SELECT conv_id, 0 AS d, '' AS path, 0 AS w FROM c
  UNION ALL SELECT conv_id, d, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d), len({_SPACED.format("text")}) FROM r
), last AS (
  SELECT conv_id, max(d) AS d FROM p GROUP BY conv_id
), nodes AS (
  SELECT path, any_value(p.d) AS d, min(p.conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(w) AS saved,
         coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE p.d = last.d), '') AS ends
  FROM p JOIN last USING (conv_id) GROUP BY path
), kids AS (
  SELECT left(path, 64 * (d - 1)::INT) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), up AS (
  SELECT left(path, 64 * unnest(range(0, d + 1))::INT) AS path, saved, path IN (SELECT path FROM kids) AS inner_node FROM nodes
), sums AS (
  SELECT path, sum(saved) AS saved, count(*) FILTER (WHERE NOT inner_node) AS leaves FROM up GROUP BY path
)
SELECT a.conv_id, a.d::BIGINT AS depth, u.conv_id AS parent_conv_id, a.n::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM nodes a JOIN sums s USING (path) LEFT JOIN kids k USING (path) LEFT JOIN nodes u ON a.d > 0 AND u.path = left(a.path, 64 * (a.d - 1)::INT)
"""

ORACLE: dict[str, str] = {
    "op3_exact_copies": EXACT_COPIES,
    "op4_benchmark_overlap": BENCHMARK_OVERLAP,
    "op9_chat_turns": CHAT_TURNS,
    "op11_sketched_copies": SKETCHED_COPIES,
    "op12_prefix_trie": PREFIX_TRIE,
}
