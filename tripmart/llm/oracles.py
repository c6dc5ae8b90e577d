"""DuckDB statements for the queries that SQL can state over whole tables."""

_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP11 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_A_Z}), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
), each_shingle AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), linked AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM each_shingle a JOIN each_shingle b
        ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 185 * count(*) >= 85 * (a.n + b.n)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.s)
"""

OP12 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(text, {_A_Z}), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), sizes AS (
    SELECT lang, w, unnest([1, 2, 3, 4]) AS k FROM words WHERE len(w) > 0
), starts AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sizes WHERE len(w) >= k
), f AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts GROUP BY 1, 2, 3
), total AS (
    SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30
), cuts AS (
    SELECT c.*, unnest(range(1, k)) AS cut FROM candidates c
), scored AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
        ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')
    QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.cut) = 1
), parts AS (
    SELECT lang, a, w, k, unnest(range(2, k)) AS size FROM candidates WHERE k > 2
), places AS (
    SELECT lang, a, w, size, unnest(range(1, k - size + 2)) AS i FROM parts
), inside AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS most FROM places GROUP BY 1, 2
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, encode(s.phrase)) AS rank,
    s.phrase, s.a, s.l, s.r, t.n, s.score
FROM scored s JOIN total t USING (lang) LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE i.most IS NULL OR 100 * i.most < 80 * s.a
QUALIFY rank <= 2000
"""

OP13 = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
        list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
    (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id))::INTEGER AS rank,
    s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
"""

_WORDS = f"coalesce(regexp_extract_all(translate(text, {_A_Z}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

OP5 = f"""
WITH docs AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), items AS (
    SELECT item_id, {_WORDS} AS w FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size,
        unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS phrase
    FROM items WHERE len(w) > 0
), places AS (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM docs, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size
), found AS (
    SELECT p.doc_id, p.i, p.size, m.item_id
    FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM places) p
    JOIN item_windows m ON m.size = p.size AND m.phrase = p.phrase
), hits AS (
    SELECT doc_id, count(DISTINCT word) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
    coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.items, '')) AS items_sha256,
    h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
"""

# Every (conv_id, turn) of the table is one row.
OP9 = """
WITH RECURSIVE users AS (
    SELECT *, 'call-' || conv_id || '-' || turn AS call_id FROM conversations WHERE role = 'user'
), answers AS (
    SELECT *, 'call-' || conv_id || '-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'
), chain AS (
    SELECT u.conv_id, u.turn, 0::BIGINT AS level FROM users u
    WHERE u.turn < 2 OR NOT EXISTS (SELECT 1 FROM users b WHERE b.conv_id = u.conv_id AND b.turn = u.turn - 2)
    UNION ALL
    SELECT u.conv_id, u.turn, c.level + 1 FROM chain c JOIN users u
        ON u.conv_id = c.conv_id AND u.turn = c.turn + 2 AND u.turn >= 2
)
SELECT u.conv_id, u.call_id, 'ask' AS name, c.level, u.turn,
    CASE WHEN a.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
    CASE WHEN u.text IS NULL THEN 'missing text' ELSE '' END AS errors,
    1::BIGINT AS n_calls, (a.turn IS NOT NULL)::BIGINT AS n_results, 1 + (a.turn IS NOT NULL)::BIGINT AS n_rows,
    '{"arguments":{' || coalesce('"text":' || to_json(u.text)::VARCHAR || ',', '') || '"turn":' || u.turn
        || coalesce(',"words":' || len(regexp_split_to_array(trim(u.text), ' +')), '') || '},"id":"' || u.call_id
        || '","name":"ask","result":' || CASE WHEN a.text IS NULL THEN 'null' ELSE to_json(a.text)::VARCHAR END || '}'
        AS canonical
FROM users u JOIN chain c ON c.conv_id = u.conv_id AND c.turn = u.turn LEFT JOIN answers a ON a.call_id = u.call_id
UNION ALL
SELECT a.conv_id, a.call_id, NULL, NULL, a.turn, 'orphan', NULL, 0, 1, 1,
    '{"arguments":null,"id":"' || a.call_id || '","name":null,"result":'
        || CASE WHEN a.text IS NULL THEN 'null' ELSE to_json(a.text)::VARCHAR END || '}'
FROM answers a WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.call_id = a.call_id)
UNION ALL
SELECT conv_id, NULL, NULL, NULL, turn, 'no call', NULL, 0, 0, 1,
    '{"role":' || CASE WHEN role IS NULL THEN 'null' ELSE to_json(role)::VARCHAR END || ',"text":'
        || CASE WHEN text IS NULL THEN 'null' ELSE to_json(text)::VARCHAR END || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')
"""
