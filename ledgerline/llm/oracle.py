"""DuckDB SQL for those queries of this folder that SQL can express, written independently of the Spark code."""

from __future__ import annotations

_WORDS = r"""
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS w FROM documents)
)"""

OP1 = "WITH " + _WORDS.format(text="coalesce(text, '')") + r""",
windows AS (
  SELECT doc_id, p, count(*) OVER w AS n, md5(string_agg(word, ' ') OVER w) AS k
  FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
),
repeated AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM windows WHERE n = 20)
  WHERE nth > 1
),
marked AS (
  SELECT w.doc_id, w.p, w.word,
         max(CASE WHEN r.p IS NOT NULL THEN w.p END)
           OVER (PARTITION BY w.doc_id ORDER BY w.p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words w LEFT JOIN repeated r ON r.doc_id = w.doc_id AND r.p = w.p
),
per_doc AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""

OP2 = r"""
WITH test AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+'),
                              lambda x: x <> '') AS w
  FROM benchmark
),
item AS (
  SELECT item_id, len(w) AS size, least(13, len(w)) AS win, unnest(w) AS token, generate_subscripts(w, 1) AS x
  FROM test WHERE len(w) >= 7
),
doc AS (
  SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+'),
                                   lambda x: x <> '') AS w FROM documents)
  WHERE len(w) >= 7
),
agree AS (
  SELECT doc_id, item_id, size, win, p - x AS o, x FROM doc JOIN item USING (token)
),
dense AS (
  SELECT doc_id, item_id, o FROM agree GROUP BY doc_id, item_id, o, win HAVING count(*) * 13 >= 10 * win
),
windowed AS (
  SELECT doc_id, item_id, o, win, size, unnest(range(greatest(1, x - win + 1), least(x, size - win + 1) + 1)) AS s
  FROM agree JOIN dense USING (doc_id, item_id, o)
),
leak AS (
  SELECT DISTINCT doc_id, item_id FROM (
    SELECT doc_id, item_id, o, s FROM windowed GROUP BY doc_id, item_id, o, s, win HAVING count(*) * 13 >= 10 * win)
),
per_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items FROM leak GROUP BY doc_id
)
SELECT d.doc_id, n IS NOT NULL AS contaminated, coalesce(n, 0)::BIGINT AS n_items, coalesce(items, '') AS items
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = "WITH RECURSIVE " + _WORDS.format(text=_AZ) + r""",
grams AS (
  SELECT doc_id, word || ' ' || next AS g
  FROM (SELECT doc_id, word, lead(word) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM words)
  WHERE next IS NOT NULL
  UNION
  SELECT doc_id, min(word) FROM words GROUP BY doc_id HAVING count(*) = 1
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * shared.n >= 80 * (sx.n + sy.n - shared.n)
),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, edge.y FROM reach JOIN edge ON reach.b = edge.x
)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

_ESCAPED = r"regexp_replace({0}, '<(\\*\|(?:im_start|im_sep|im_end|endoftext)\|>)', '<\\\1', 'g')"

OP4 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, sha256(text))) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, sha256(text)) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       sum(length(""" + _ESCAPED.format("role") + ") + length(" + _ESCAPED.format("text") + r""") + 32)::BIGINT
         AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP9 = r"""
WITH split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages)
),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN fits USING (page_id)
"""

OP11 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list({'r': r, 't': t}
           ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || t)) AS s
  FROM turns GROUP BY conv_id
),
-- crc32 of the decimal id: a byte, then eight shifts
steps AS (
  SELECT conv_id, list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
           lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))) AS l, s FROM own
),
hashed AS (
  SELECT conv_id, s, xor(list_reduce(l, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
           ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 9 AS h FROM steps
),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(list_slice(b.s, 1, a.h), []), list_slice(a.s, a.h + 1, len(a.s))) AS s
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5
),
beginnings AS (
  SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM rebuilt
),
node AS (
  SELECT depth, list_slice(s, 1, depth) AS k, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(s) = depth), '')) AS ends_sha256
  FROM beginnings GROUP BY 1, 2
),
children AS (
  SELECT depth - 1 AS depth, list_slice(k, 1, depth - 1) AS k, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1, 2
),
one AS (
  SELECT node.*, coalesce(n, 0) AS n_children,
         CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(k[depth].t) ELSE 0 END AS saved
  FROM node LEFT JOIN children USING (depth, k)
),
above AS (
  SELECT a, list_slice(k, 1, a) AS k, n_children, saved
  FROM (SELECT unnest(range(0, depth + 1)) AS a, k, n_children, saved FROM one)
),
subtree AS (
  SELECT a AS depth, k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1, 2
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM one o JOIN subtree t ON t.depth = o.depth AND t.k = o.k
LEFT JOIN node p ON p.depth = o.depth - 1 AND p.k = list_slice(o.k, 1, o.depth - 1)
"""

_WHOLE = r"""
usable AS (
  SELECT {columns}, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)"""

OP12 = "WITH " + _WHOLE.format(columns="vec_id", scale=1024) + r""",
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

OP13 = "WITH " + _WHOLE.format(columns="vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label",
                               scale=256) + r""",
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id
  WHERE a.label IS NOT NULL AND c.label IS NOT NULL
),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""

ORACLE_SQL = {
    "op1_substring_dedup": OP1,
    "op2_decontamination": OP2,
    "op3_minhash_near_dedup": OP3,
    "op4_chat_formatting": OP4,
    "op9_url_filter": OP9,
    "op11_prefix_trie": OP11,
    "op12_exact_top_k": OP12,
    "op13_hard_negatives": OP13,
}
