"""The same results in SQL for DuckDB, written a different way: list folds, windows and recursive
queries over the given tables."""

from __future__ import annotations

from docpipe.plans.catalog import CRAWL_FILTER, SCOPE_FILTER

LIMIT = 2048
MARK = "chr(1)"

DOCS = "docs AS (SELECT 'doc_' || doc_id || '.md' AS source_path, text FROM documents)"


def _split(text: str, pattern: str, replacement: str) -> str:
    """Pieces of ``text`` cut where the pattern puts a mark."""
    marked = f"regexp_replace({text}, '{pattern}', {replacement}, 'g')"
    return f"list_filter(string_split({marked}, {MARK}), lambda p: p <> '')"


def _merge(pieces: str) -> str:
    return f"""list_reduce(list_transform({pieces}, lambda p: [p]), lambda a, b:
      CASE WHEN length(a[-1]) + length(b[1]) <= {LIMIT}
           THEN list_concat(a[1:-2], [a[-1] || b[1]]) ELSE list_concat(a, b) END)"""


def _recursive_chunks() -> str:
    """CTEs docs .. chunks(source_path, chunk_index, text)."""
    cuts = [
        _merge(_split("text", "(#+)", rf"{MARK} || '\1'")),
        _merge(_split("text", r"(\n\n+)", rf"'\1' || {MARK}")),
        _merge(_split("text", r"(\n)", rf"'\1' || {MARK}")),
        _merge(_split("text", r"([.!?] )", rf"'\1' || {MARK}")),
        _merge(_split("text", r"([ \t\r\n\f])", rf"'\1' || {MARK}")),
        f"list_transform(range(0, ((length(text) - 1) // {LIMIT}) + 1),"
        f" lambda i: substring(text, (i * {LIMIT} + 1)::INT, {LIMIT}))",
    ]
    ctes = [DOCS, "l0 AS (SELECT source_path, text, []::BIGINT[] AS place FROM docs WHERE text <> '')"]
    for i, cut in enumerate(cuts, 1):
        ctes.append(f"""l{i} AS (
    SELECT source_path, unnest(parts) AS text,
           list_append(place, unnest(range(1, len(parts) + 1))) AS place
    FROM (SELECT source_path, place,
                 CASE WHEN length(text) > {LIMIT} THEN {cut} ELSE [text] END AS parts
          FROM l{i - 1}))""")
    ctes.append(f"""chunks AS (
    SELECT source_path, text,
           (row_number() OVER (PARTITION BY source_path ORDER BY place) - 1)::INTEGER AS chunk_index
    FROM l{len(cuts)})""")
    return ",\n".join(ctes)


CHUNKS = _recursive_chunks()

# CRC-32 (polynomial 0xEDB88320) of each distinct word, and the bucket it gives.
CRC = """crc_table AS (
    SELECT list_transform(range(0, 256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
words AS (
    SELECT key, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM texts),
hashed AS (
    SELECT word, (xor(list_reduce(list_concat([4294967295], list_transform(
               range(0, length(hex(encode(word))) // 2),
               lambda i: ('0x' || substring(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 64)::INTEGER AS bucket
    FROM (SELECT DISTINCT word FROM words), crc_table),
counted AS (
    SELECT key, bucket, count(*)::DOUBLE AS n FROM words JOIN hashed USING (word) GROUP BY ALL),
weights AS (
    SELECT key, bucket, (n / sqrt(sum(n * n) OVER (PARTITION BY key)))::FLOAT AS weight FROM counted),
vectors AS (
    SELECT k.key, list(coalesce(w.weight, 0)::DOUBLE ORDER BY d.b) AS vector
    FROM (SELECT DISTINCT key FROM weights) AS k
    CROSS JOIN (SELECT unnest(range(0, 64)) AS b) AS d
    LEFT JOIN weights AS w ON w.key = k.key AND w.bucket = d.b
    GROUP BY k.key)"""

DISTANCE = "list_sum(list_transform(range(1, 65), lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) ** 2))"

LINKS = r"""hrefs AS (
    SELECT page_id, url, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href
    FROM pages),
found AS (
    SELECT page_id, url,
           regexp_replace(replace(replace(replace(href, '&quot;', '"'), '&copy;', '©'),
                                  '&middot;', '·'), '&amp;?', '&', 'g') AS href
    FROM hrefs),
kept AS (SELECT * FROM found WHERE NOT starts_with(href, '#')),
resolved AS (
    SELECT page_id, url, href,
           regexp_extract(url, '^[a-z]+://[^/]+') || split_part(href, '#', 1) AS target
    FROM kept)"""


def _decoded(text: str) -> str:
    for entity, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return text


def _visible(markup: str) -> str:
    """Text of a piece of markup: tags out, entities decoded, white space collapsed."""
    bare = _decoded(f"regexp_replace({markup}, '<[a-zA-Z/!][^>]*>', '', 'g')")
    return rf"trim(regexp_replace({bare}, '[ \t\r\n\f]+', ' ', 'g'))"


ARTICLE = r"regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)"

# Paragraphs nest when their end tags are missing. A closing </p> ends the nearest open paragraph,
# which at one nesting level is the token before it on that level.
MARKDOWN = rf"""tok AS (
    SELECT page_id, unnest(toks) AS tok, unnest(range(0, len(toks))) AS i
    FROM (SELECT page_id, regexp_extract_all({ARTICLE}, '<[a-zA-Z/][^>]*>|[^<]+') AS toks FROM pages)),
level AS (
    SELECT *, lead(tok) OVER w = '<b>' AS bold, lag(tok, 2) OVER w AS opened,
           sum(CASE tok WHEN '<p>' THEN 1 WHEN '</p>' THEN -1 ELSE 0 END) OVER w
             + CASE WHEN tok = '</p>' THEN 1 ELSE 0 END AS lvl
    FROM tok WINDOW w AS (PARTITION BY page_id ORDER BY i)),
matched AS (
    SELECT *, lag(bold) OVER (PARTITION BY page_id, lvl, tok IN ('<p>', '</p>') ORDER BY i) AS was_bold,
           lead(i) OVER (PARTITION BY page_id, lvl, tok IN ('<p>', '</p>') ORDER BY i) AS next_i
    FROM level),
body AS (
    SELECT page_id, string_agg(CASE
        WHEN tok = '<h1>' THEN chr(1) || '#' || chr(3)
        WHEN tok IN ('</h1>', '<p>') THEN chr(1)
        WHEN tok = '<b>' THEN '**'
        WHEN tok = '<br>' THEN chr(3) || chr(3) || chr(2)
        WHEN starts_with(tok, '<a ') THEN '['
        WHEN tok = '</a>' THEN '](' || regexp_extract(opened, 'href="([^"]*)"', 1) || ')'
        WHEN tok = '</p>' THEN CASE WHEN was_bold THEN '**' ELSE '' END || chr(1)
        ELSE regexp_replace({_decoded("tok")}, '[ \t\r\n\f]+', ' ', 'g') END, '' ORDER BY i) AS md
    FROM matched GROUP BY page_id),
tail AS (
    SELECT page_id, string_agg(CASE WHEN bold THEN '**' ELSE '' END || chr(1), '' ORDER BY lvl DESC) AS md
    FROM matched WHERE tok = '<p>' AND next_i IS NULL GROUP BY page_id),
joined AS (
    SELECT page_id, body.md || coalesce(tail.md, '') AS md FROM body LEFT JOIN tail USING (page_id)),
markdowns AS (
    SELECT page_id, replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(md,
        '[ \x02\x03]*\x01[ \x01\x02]*', E'\n\n', 'g'),
        ' {{2,}}', ' ', 'g'),
        ' *\x02[ \x02]*', E'\n', 'g'),
        '^[ \n]+|[ \n]+$', '', 'g'), chr(3), ' ') AS markdown
    FROM joined)"""

PATHS = r"""paths AS (
    SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
           CASE WHEN trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') = '' THEN 'index.md'
                ELSE trim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') || '.md'
           END AS output_path
    FROM pages),
latest AS (
    SELECT * FROM paths QUALIFY row_number() OVER (
        PARTITION BY host, output_path ORDER BY page_id DESC, url DESC) = 1)"""

SITE = rf"""{PATHS},
nodes AS (SELECT page_id, '/' || output_path || '?page=' || page_id AS path FROM paths),
site AS (
    SELECT p.page_id, 'https://docs.example.org' || n.path AS url,
           replace(html, '<article>', '<article>'
             || coalesce('<a href="' || a.path || '">1</a>', '')
             || coalesce('<a href="' || b.path || '">2</a>', '')) AS html
    FROM pages AS p JOIN nodes AS n USING (page_id)
    LEFT JOIN nodes AS a ON a.page_id = 2 * p.page_id + 1
    LEFT JOIN nodes AS b ON b.page_id = 2 * p.page_id + 2),
reach AS (
    SELECT page_id FROM nodes WHERE page_id = 0
    UNION ALL
    SELECT n.page_id FROM reach AS r
    JOIN nodes AS n ON n.page_id > 0 AND (n.page_id - 1) // 2 = r.page_id
    WHERE contains('https://docs.example.org' || n.path, '{CRAWL_FILTER}')),
newest AS (
    SELECT max(page_id) AS page_id, output_path FROM reach JOIN paths USING (page_id)
    GROUP BY output_path),
{MARKDOWN.replace("FROM pages", "FROM site")}"""

SENTENCES = f"""split AS (
    SELECT source_path, {_split("text", r"([.!?][ \t\r\n\f])", rf"'\1' || {MARK}")} AS parts FROM docs),
sentence AS (
    SELECT source_path, unnest(parts) AS sentence,
           unnest(range(0, len(parts)))::INTEGER AS sentence_index FROM split)"""

TOKEN_WINDOWS = r"""tokens AS (
    SELECT source_path, regexp_extract_all(text, '\s*\S+\s*') AS toks FROM docs),
windows AS (
    SELECT source_path, toks,
           unnest(range(0, greatest(ceil((len(toks) - 512) / 384.0)::INT, 0) + 1)) AS i
    FROM tokens WHERE len(toks) > 0)"""

SEMANTIC = rf"""pieces AS (
    SELECT source_path, sentence_index, sentence,
           regexp_extract_all(sentence, '\s*\S+\s*') AS toks FROM sentence),
cut AS (
    SELECT source_path, sentence_index, unnest(range(0, len(parts))) AS j, unnest(parts) AS part
    FROM (SELECT source_path, sentence_index, CASE WHEN len(toks) > 200
                 THEN list_transform(range(0, ((len(toks) - 1) // 200) + 1),
                                     lambda i: array_to_string(toks[i * 200 + 1 : i * 200 + 200], ''))
                 ELSE [sentence] END AS parts FROM pieces)),
units AS (
    SELECT source_path, part, len(regexp_extract_all(part, '\S+')) AS n,
           row_number() OVER (PARTITION BY source_path ORDER BY sentence_index, j) AS i FROM cut),
texts AS (SELECT source_path || ' ' || i AS key, part AS text FROM units),
{CRC},
compared AS (
    SELECT u.source_path, u.part, u.n, u.i,
           round(list_sum(list_transform(range(1, 65), lambda d: a.vector[d] * b.vector[d]))
                 / (sqrt(list_sum(list_transform(a.vector, lambda x: x * x)))
                    * sqrt(list_sum(list_transform(b.vector, lambda x: x * x)))), 6) AS likeness
    FROM units AS u
    LEFT JOIN vectors AS a ON a.key = u.source_path || ' ' || u.i
    LEFT JOIN vectors AS b ON b.key = u.source_path || ' ' || (u.i - 1)),
folded AS (
    SELECT source_path, list_reduce(list({{
               'done': []::STRUCT(text VARCHAR, n BIGINT, parts BIGINT)[], 'text': part,
               'n': n::BIGINT, 'parts': 1::BIGINT, 'likeness': likeness}} ORDER BY i),
           lambda a, b: CASE
             WHEN a.n + b.n > 200 OR (a.n >= 50 AND coalesce(b.likeness < 0.5, FALSE))
             THEN {{'done': list_append(a.done, {{'text': a.text, 'n': a.n, 'parts': a.parts}}),
                   'text': b.text, 'n': b.n, 'parts': b.parts, 'likeness': b.likeness}}
             ELSE {{'done': a.done, 'text': a.text || b.text, 'n': a.n + b.n,
                   'parts': a.parts + b.parts, 'likeness': b.likeness}} END) AS r
    FROM compared GROUP BY source_path),
grouped AS (
    SELECT source_path, unnest(all_groups) AS g, unnest(range(0, len(all_groups))) AS i
    FROM (SELECT source_path,
                 list_append(r.done, {{'text': r.text, 'n': r.n, 'parts': r.parts}}) AS all_groups
          FROM folded))"""


def _means(keys: str, column: str) -> str:
    group = f"{keys}, " if keys else ""
    return f"""parts AS (
    SELECT {group}unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings),
means AS (SELECT {group}i, round(avg(x), 6) AS x FROM parts GROUP BY {group}i),
centres AS (SELECT {f"{keys} AS {column}, " if keys else ""}list(x ORDER BY i) AS centre
            FROM means {f"GROUP BY {keys}" if keys else ""})"""


def _asked(k: int) -> str:
    """Hits of every benchmark text among the chunks."""
    return f"""{CHUNKS},
questions AS (SELECT item_id AS query_id, text FROM benchmark),
texts AS (
    SELECT source_path || '_' || chunk_index AS key, text FROM chunks
    UNION ALL SELECT '?' || query_id, text FROM questions),
{CRC},
pairs AS (
    SELECT q.query_id, source_path || '_' || chunk_index AS id, source_path, c.text,
           {DISTANCE.format(a="vq.vector", b="vc.vector")} AS distance
    FROM questions AS q
    JOIN vectors AS vq ON vq.key = '?' || q.query_id
    CROSS JOIN chunks AS c
    JOIN vectors AS vc ON vc.key = c.source_path || '_' || c.chunk_index),
hits AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INTEGER AS rank
    FROM pairs QUALIFY rank <= {k})"""


ORACLE: dict[str, str] = {
    "store_roundtrip": """
SELECT 'vec_' || vec_id AS id, 'vector of label ' || label AS text,
       'label_' || label AS source_path, len(embedding)::INTEGER AS width,
       round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS squares
FROM embeddings""",
    "store_count": "SELECT 2 * count(*) AS n_rows FROM embeddings",
    "store_rebuild": """
SELECT 'label_' || label AS source_path, count(*) AS n_rows, max(len(embedding))::INTEGER AS width,
       (SELECT count(*) FROM embeddings WHERE label <> 0) AS n_all
FROM embeddings WHERE label <> 0 GROUP BY label""",
    "page_sink_latest": f"""WITH {PATHS}, {MARKDOWN}
SELECT host, output_path, page_id, url, markdown FROM latest JOIN markdowns USING (page_id)""",
    "chunk_counts": f"""WITH {CHUNKS}
SELECT 'doc_' || doc_id || '.md' AS source_path, count(chunks.source_path) AS n_chunks
FROM documents LEFT JOIN chunks ON chunks.source_path = 'doc_' || doc_id || '.md' GROUP BY ALL""",
    "corpus_totals": f"""WITH {CHUNKS}
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_documents,
       (SELECT count(*) FROM chunks)::BIGINT AS n_chunks""",
    "page_content": f"""
SELECT page_id, 'article' AS content_tag, {_visible(ARTICLE)} AS content_text FROM pages""",
    "page_prune": f"""
SELECT page_id, len(regexp_extract_all(html, '<nav'))::INTEGER AS n_removed,
       {_visible("regexp_replace(html, '(?s)<head>.*?</head>|<nav>.*?</nav>|<!--.*?-->', '', 'g')")}
       AS page_text
FROM pages""",
    "page_markdown": f"WITH {MARKDOWN} SELECT page_id, markdown FROM markdowns",
    "page_output_path": f"WITH {PATHS} SELECT page_id, url, host, output_path FROM paths",
    "page_prune_stats": """
SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, count(*) AS n_pages,
       sum(len(regexp_extract_all(html, '<nav')))::BIGINT AS n_removed
FROM pages GROUP BY ALL""",
    "page_links": f"WITH {LINKS} SELECT page_id, url, href FROM kept",
    "links_resolved": f"WITH {LINKS} SELECT page_id, href, target FROM resolved",
    "links_in_scope": f"""WITH {LINKS},
largest AS (SELECT split_part(url, '/', 3) AS host FROM pages
            GROUP BY ALL ORDER BY count(*) DESC, host LIMIT 1)
SELECT page_id, target FROM resolved
WHERE split_part(target, '/', 3) = (SELECT host FROM largest) AND contains(target, '{SCOPE_FILTER}')""",
    "links_unvisited": f"""WITH {LINKS}
SELECT DISTINCT target AS url FROM resolved WHERE NOT contains(url, '?')
AND target NOT IN (SELECT target FROM resolved WHERE contains(url, '?'))""",
    "links_dangling": f"""WITH {LINKS}
SELECT target AS url, count(*) AS n_links FROM resolved
WHERE target NOT IN (SELECT split_part(url, '#', 1) FROM pages WHERE NOT contains(url, '?'))
GROUP BY target""",
    "crawl_reach": f"""WITH RECURSIVE {PATHS},
nodes AS (
    SELECT page_id, 'https://docs.example.org/' || output_path || '?page=' || page_id AS url FROM paths),
reach AS (
    SELECT page_id, url, 0 AS depth FROM nodes WHERE page_id = 0
    UNION ALL
    SELECT n.page_id, n.url, r.depth + 1 FROM reach AS r
    JOIN nodes AS n ON n.page_id > 0 AND (n.page_id - 1) // 2 = r.page_id
    WHERE contains(n.url, '{CRAWL_FILTER}'))
SELECT url, depth::INTEGER AS depth FROM reach""",
    "site_crawl": f"""WITH RECURSIVE {SITE}
SELECT page_id, site.url AS url, 'docs.example.org' AS host, output_path || '.md' AS output_path,
       markdown
FROM newest JOIN site USING (page_id) JOIN markdowns USING (page_id)""",
    "chunk_recursive": f"WITH {CHUNKS} SELECT source_path, chunk_index, text FROM chunks",
    "chunk_offsets": f"""WITH {CHUNKS},
spans AS (
    SELECT source_path, chunk_index, length(text)::INTEGER AS token_count,
           sum(length(text)) OVER (PARTITION BY source_path ORDER BY chunk_index)::INTEGER AS end_index
    FROM chunks)
SELECT source_path, chunk_index, end_index - token_count AS start_index, end_index, token_count
FROM spans""",
    "chunk_tokens": f"""WITH {DOCS}, {TOKEN_WINDOWS},
cut AS (
    SELECT source_path, i::INTEGER AS chunk_index, toks[i * 384 + 1 : i * 384 + 512] AS part,
           length(array_to_string(toks[1 : i * 384], '')) AS start_index FROM windows)
SELECT source_path, chunk_index, array_to_string(part, '') AS text,
       start_index::INTEGER AS start_index,
       (start_index + length(array_to_string(part, '')))::INTEGER AS end_index,
       len(part)::INTEGER AS token_count
FROM cut""",
    "chunk_semantic": f"""WITH {DOCS}, {SENTENCES}, {SEMANTIC}
SELECT source_path, i::INTEGER AS chunk_index, g.text AS text,
       (sum(length(g.text)) OVER w - length(g.text))::INTEGER AS start_index,
       (sum(length(g.text)) OVER w)::INTEGER AS end_index,
       g.n::INTEGER AS token_count, g.parts::INTEGER AS n_sentences
FROM grouped WINDOW w AS (PARTITION BY source_path ORDER BY i)""",
    "sentences": f"WITH {DOCS}, {SENTENCES} SELECT source_path, sentence_index, sentence FROM sentence",
    "chunk_ids": f"""WITH {CHUNKS}
SELECT source_path || '_' || chunk_index AS id, source_path, chunk_index FROM chunks""",
    "chunk_token_stats": rf"""WITH {CHUNKS},
counted AS (SELECT source_path, len(regexp_extract_all(text, '\S+'))::INTEGER AS n FROM chunks)
SELECT 'doc_' || doc_id || '.md' AS source_path, count(n) AS n_chunks, min(n) AS min_tokens,
       round(avg(n), 6) AS avg_tokens, max(n) AS max_tokens
FROM documents LEFT JOIN counted ON counted.source_path = 'doc_' || doc_id || '.md' GROUP BY ALL""",
    "embed_hashed": f"""WITH {DOCS}, texts AS (SELECT source_path AS key, text FROM docs), {CRC}
SELECT key AS source_path, bucket, round(weight::DOUBLE, 6) AS weight FROM weights""",
    "embed_model": f"""WITH {CHUNKS}
SELECT source_path || '_' || chunk_index AS id, length(text)::DOUBLE AS chars,
       (length(text) - length(replace(text, 'e', '')))::DOUBLE AS letters_e,
       (length(text) - length(replace(text, ' ', '')))::DOUBLE AS spaces
FROM chunks WHERE regexp_matches(text, '\\S')""",
    "embed_valid_only": """
SELECT 'vec_' || vec_id AS id, 'label_' || label AS source_path FROM embeddings WHERE NOT ends_with(label::VARCHAR, '3')""",
    "embed_failures": """
SELECT 'label_' || label AS source_path, count(*) FILTER (NOT ends_with(label::VARCHAR, '3')) AS n_stored,
       count(*) FILTER (ends_with(label::VARCHAR, '3')) AS n_dropped
FROM embeddings GROUP BY label""",
    "knn_top_k": f"""WITH {_means("", "")},
measured AS (
    SELECT vec_id, label, {DISTANCE.format(a="embedding", b="centre")} AS distance
    FROM embeddings, centres)
SELECT vec_id, label, round(distance, 6) AS distance FROM measured
ORDER BY measured.distance, vec_id LIMIT 10""",
    "knn_batch": f"""WITH {_means("label", "query_id")},
measured AS (
    SELECT query_id, vec_id, {DISTANCE.format(a="embedding", b="centre")} AS distance
    FROM embeddings, centres)
SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, round(distance, 6) AS distance
FROM measured WINDOW w AS (PARTITION BY query_id ORDER BY measured.distance, vec_id) QUALIFY rank <= 5""",
    "knn_small_scale": f"""WITH {_means("label", "query_id")},
small AS (
    SELECT query_id, vec_id, list_transform(embedding, lambda x: x::DOUBLE * 1e-6) AS v,
           list_transform(centre, lambda x: x * 1e-6) AS c
    FROM embeddings, centres),
measured AS (SELECT query_id, vec_id, {DISTANCE.format(a="v", b="c")} AS distance FROM small)
SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id,
       round(distance / min(distance) OVER (PARTITION BY query_id), 6) AS distance
FROM measured WINDOW w AS (PARTITION BY query_id ORDER BY measured.distance, vec_id) QUALIFY rank <= 5""",
    "knn_report": f"""WITH {_asked(3)}
SELECT query_id, rank, id, source_path, substring(text, 1, 150) AS text FROM hits""",
    "site_to_markdown": f"""WITH {PATHS}, {MARKDOWN}
SELECT page_id, url, host, output_path, markdown FROM latest JOIN markdowns USING (page_id)""",
    "index_build": f"""WITH {CHUNKS},
texts AS (SELECT source_path || '_' || chunk_index AS key, text FROM chunks), {CRC},
used AS (SELECT key, count(*)::INTEGER AS n_buckets FROM weights GROUP BY key)
SELECT key AS id, source_path, text, n_buckets
FROM used JOIN chunks ON key = source_path || '_' || chunk_index""",
    "index_semantic": f"""WITH {DOCS}, {SENTENCES}, {SEMANTIC}
SELECT source_path || '_' || i AS id, source_path, g.text AS text FROM grouped
WHERE regexp_matches(g.text, '[\\p{{L}}\\p{{N}}]')""",
    "retrieve": f"""WITH {_asked(5)}
SELECT query_id, rank, id, source_path, text, round(distance, 6) AS distance FROM hits""",
}
