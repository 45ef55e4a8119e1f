"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {
    "op1_warc": """
        WITH hashed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages
        ), firsts AS (
            SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
                   -- Five hexadecimal digits are four digits of base 32.
                   list_transform(range(0, 8), lambda i:
                       ('0x' || substr(hex, CAST(i AS INTEGER) * 5 + 1, 5))::BIGINT) AS n
            FROM hashed
        )
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(n, lambda v:
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 15) & 31 AS INTEGER) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 10) & 31 AS INTEGER) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> 5) & 31 AS INTEGER) + 1, 1) ||
                   substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v & 31 AS INTEGER) + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM firsts
    """,
    "op4_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_minhash": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingled AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(w) = 0 THEN []
                     WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END
            ) AS s
            FROM worded
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
            FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id < y.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared
            JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * c >= 75 * (p.n + q.n - c)
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT r.doc_id, CASE WHEN l.a = r.other THEN l.b ELSE l.a END
            FROM reach r JOIN links l ON l.a = r.other OR l.b = r.other
        ), smallest AS (
            SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM smallest LEFT JOIN sizes USING (doc_id)
    """,
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents
        ), toks AS (
            SELECT rid, lang, source, unnest(regexp_split_to_array(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM d
        ), groups AS (
            SELECT DISTINCT lang, source FROM d
        ), kept AS (
            SELECT lang, term FROM toks WHERE term <> '' GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
        ), vocab AS (
            SELECT lang, count(*) AS v FROM kept GROUP BY lang
        ), counted AS (
            SELECT lang, source, term, count(*) AS c FROM toks JOIN kept USING (lang, term) GROUP BY ALL
        ), dense AS (
            SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c
            FROM groups g JOIN kept k ON g.lang = k.lang
            LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), scored AS (
            SELECT dense.*, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + v) AS p
            FROM dense JOIN vocab USING (lang)
        ), lang_scored AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + v) AS q
            FROM (SELECT lang, term, sum(c) AS c FROM dense GROUP BY lang, term) JOIN vocab USING (lang)
        ), pair_sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM scored a JOIN scored b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        ), terms AS (
            SELECT s.lang, s.source, 'term' AS part, s.term AS item, (s.p - l.q) * (s.p - l.q) // l.q AS value
            FROM scored s JOIN lang_scored l USING (lang, term)
            WHERE s.c > 0 AND s.p > l.q
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
    "op12_conversation_trie": """
        WITH t AS (
            SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id
                                      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), cs AS (
            -- crc32 of the decimal conv_id, bit by bit.
            SELECT c, c - c % 5 AS base,
                   xor(list_reduce(list_transform(str_split(CAST(c AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
                       lambda acc, b: list_reduce(range(8), lambda y, k:
                           xor(y >> 1, CASE WHEN (y & 1) = 1 THEN 3988292384 ELSE 0 END), xor(acc, b)),
                       CAST(4294967295 AS BIGINT)), 4294967295) % 9 AS h
            FROM (SELECT DISTINCT conv AS c FROM t)
        ), rebuilt AS (
            SELECT cs.c AS conv, t.pos, t.role, t.text FROM cs JOIN t ON t.conv = cs.base AND t.pos < cs.h
            UNION ALL
            SELECT cs.c, t.pos, t.role, t.text FROM cs JOIN t ON t.conv = cs.c AND t.pos >= cs.h
        ), ids AS (
            SELECT role, text, dense_rank() OVER (ORDER BY role, text) AS tid
            FROM (SELECT DISTINCT role, text FROM rebuilt)
        ), seqs AS (
            SELECT cs.c AS conv, coalesce(list(i.tid ORDER BY r.pos) FILTER (WHERE i.tid IS NOT NULL), []) AS seq
            FROM cs LEFT JOIN rebuilt r ON r.conv = cs.c LEFT JOIN ids i ON i.role = r.role AND i.text = r.text
            GROUP BY cs.c
        ), prefixes AS (
            SELECT conv, d, seq[1:d] AS key, len(seq) AS total
            FROM (SELECT conv, seq, unnest(range(0, len(seq) + 1)) AS d FROM seqs)
        ), nodes AS (
            SELECT key, d AS depth, count(*) AS n_convs, min(conv) AS conv_id,
                   sha256(coalesce(string_agg(CASE WHEN total = d THEN CAST(conv AS VARCHAR) END, ',' ORDER BY conv), ''))
                       AS ends_sha256
            FROM prefixes GROUP BY key, d
        ), own AS (
            SELECT n.*, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(i.text) END AS own_saved,
                   (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.key[1:n.depth] = n.key) AS n_children
            FROM nodes n LEFT JOIN ids i ON n.depth > 0 AND i.tid = n.key[n.depth]
        )
        SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children,
               (SELECT count(*) FROM own b WHERE b.depth >= a.depth AND b.key[1:a.depth] = a.key AND b.n_children = 0)
                   AS n_leaves,
               (SELECT sum(b.own_saved) FROM own b WHERE b.depth >= a.depth AND b.key[1:a.depth] = a.key)
                   AS saved_tokens,
               a.ends_sha256
        FROM own a LEFT JOIN nodes p ON p.depth = a.depth - 1 AND p.key = a.key[1:a.depth - 1] AND a.depth > 0
    """,
}
