"""DuckDB SQL for the searches and the conversation trie."""

TOP_PRODUCTS = """
WITH parts AS (
    SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d
    FROM embeddings),
whole AS (SELECT vec_id, d, floor(256 * x::DOUBLE)::BIGINT AS v FROM parts),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.v * c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.d = c.d AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
    GROUP BY q.vec_id, c.vec_id),
ranked AS (
    SELECT query_id, vec_id, score,
        (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
    FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: The unsigned CRC-32 of the decimal id, bit by bit.
_CRC = """
xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT,
        list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda crc, byte: list_reduce(
        [xor(crc, byte), 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT],
        lambda v, step: xor(v >> 1, 3988292384 * (v & 1)))))
"""

CONVERSATION_TRIE = f"""
WITH given AS (
    SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}}
        ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, turns, ({_CRC}) % 4 AS h FROM given),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:c.h], c.turns[c.h + 1:]) AS turns
    FROM heads c LEFT JOIN given b ON b.conv_id = c.conv_id - c.conv_id % 20),
prefixes AS (
    SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
members AS (
    SELECT conv_id, depth, n, turns[:depth] AS path, turns[depth].t AS text FROM prefixes),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * any_value(CASE WHEN depth = 0 THEN 0
            ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END) AS saving,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
            FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM members GROUP BY path, depth),
places AS (
    SELECT m.conv_id AS member, m.depth, k.conv_id
    FROM members m JOIN nodes k ON k.path = m.path AND k.depth = m.depth),
children AS (
    SELECT p.conv_id, p.depth, count(*) AS n_children
    FROM nodes k JOIN places p ON p.member = k.conv_id AND p.depth = k.depth - 1
    GROUP BY p.conv_id, p.depth),
counted AS (
    SELECT k.*, coalesce(c.n_children, 0) AS n_children
    FROM nodes k LEFT JOIN children c ON c.conv_id = k.conv_id AND c.depth = k.depth),
sums AS (
    SELECT p.conv_id, p.depth, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves,
        sum(u.saving)::BIGINT AS saved_tokens
    FROM counted u JOIN places p ON p.member = u.conv_id AND p.depth <= u.depth
    GROUP BY p.conv_id, p.depth)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children,
    s.n_leaves, s.saved_tokens, k.ends_sha256
FROM counted k
JOIN sums s ON s.conv_id = k.conv_id AND s.depth = k.depth
LEFT JOIN places p ON p.member = k.conv_id AND p.depth = k.depth - 1
"""

RANKED_LEXICAL = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
asked AS (
    SELECT item_id, term, count(*) AS often FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark)
    GROUP BY item_id, term),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
sizes AS (
    SELECT doc_id, 25 + (75 * n * count(*) OVER ()) // (sum(n) OVER ())::BIGINT AS m,
        count(*) OVER () AS total
    FROM (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id)),
weights AS (
    SELECT term, floor(1000 * ln((2 * (SELECT any_value(total) FROM sizes) + 2)::DOUBLE
        / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
    SELECT item_id, doc_id,
        sum(often * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id)
    GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, doc_id, score,
        (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
