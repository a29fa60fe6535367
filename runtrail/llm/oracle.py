"""SQL twins of the queries that SQL can express."""

BLANKS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT row, sum(n - 1) AS n_dup_lines FROM (
    SELECT row, line, count(*) AS n FROM lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row, line) GROUP BY row),
word AS (SELECT row, unnest(words) AS w, unnest(range(len(words))) AS i FROM d),
gram AS (
  SELECT row, i, lead(w, 4) OVER p AS last,
         concat_ws(' ', w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p) AS g
  FROM word WINDOW p AS (PARTITION BY row ORDER BY i)),
twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM gram WHERE last IS NOT NULL)
  WHERE n > 1),
rep AS (SELECT row, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) AS r(k) GROUP BY row),
m AS (
  SELECT d.row, doc_id, len(words)::BIGINT AS n_words,
         len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) AS n_letter_words,
         length(regexp_replace(text, '{BLANKS}', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup ON d.row = dup.row LEFT JOIN rep ON d.row = rep.row),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR (n_dup_lines > 3 AND 20 * n_dup_lines > n_words)
            OR 2 * n_letter_words < n_words) AS kept
FROM b
"""

URLS = rf"""
WITH a AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), {UPPER}, {LOWER}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM a),
listed AS (SELECT DISTINCT host || path AS key FROM p WHERE host <> '' AND regexp_matches(url, '[?&]utm_')),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN host <> '' AND host || path IN (SELECT key FROM listed) THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""

MIX = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS tag
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, 2 * source_size / weight AS ratio,
         (sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER
            (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS level
  FROM s WINDOW o AS (ORDER BY 2 * source_size / weight, source NULLS LAST)),
t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(
           (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1) * weight,
           2.0::DOUBLE * source_size)) AS target
  FROM l),
q AS (
  SELECT d.row, d.doc_id, d.source, tag, size, source_size, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY tag, size, row)::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, (upto + copy * source_size) / target AS finish FROM q, (VALUES (0), (1)) AS c(copy)),
g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, tag, size, copy, row)::BIGINT - size AS start
  FROM f WHERE size > 0),
b AS (SELECT floor(round(sum(target), 6))::BIGINT AS budget FROM t),
k AS (SELECT row, sum(greatest(0, least(size, budget - start)))::BIGINT AS taken FROM g, b GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM q LEFT JOIN k ON q.row = k.row
"""

LINES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^{BLANKS}+|{BLANKS}+$', '', 'g'), {UPPER}, {LOWER}) AS key FROM l),
m AS (
  SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, coalesce(doc_id > first_doc, false) AS lost FROM k LEFT JOIN m ON k.key = m.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM j GROUP BY row, doc_id
"""

WARC = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, coalesce(html, '') AS payload FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) END AS first_id FROM p)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""

# The CRC-32 of a conversation's decimal id, bit by bit.
TRIE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
o AS (
  SELECT *, md5(length(role) || ':' || role || text) AS mark,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS place
  FROM t),
own AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base,
         xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT for i in range(8)]),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 6 AS head
  FROM o GROUP BY conv_id),
c AS (
  SELECT a.conv_id, a.base, a.head, least(a.head, coalesce(b.n, 0)) AS taken,
         least(a.head, coalesce(b.n, 0)) + greatest(a.n - a.head, 0) AS length
  FROM own a LEFT JOIN own b ON b.conv_id = a.base),
r AS (
  SELECT c.conv_id, place AS depth, mark, text FROM c JOIN o ON o.conv_id = c.base AND place <= taken
  UNION ALL SELECT c.conv_id, taken + place - head, mark, text FROM c JOIN o ON o.conv_id = c.conv_id AND place > head),
p AS (
  SELECT conv_id, depth, length(text) AS chars, list(mark) OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, [] FROM c),
n AS (SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY key),
m AS (SELECT p.conv_id, p.depth, n.conv_id AS node FROM p JOIN n ON p.key = n.key),
f AS (
  SELECT n.*, m.node AS parent FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1),
k AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM f WHERE depth > 0 GROUP BY parent, depth),
g AS (SELECT f.*, coalesce(n_children, 0) AS n_children FROM f LEFT JOIN k ON k.parent = f.conv_id AND k.depth = f.depth),
s AS (
  SELECT m.node, m.depth, sum((g.n_children = 0)::BIGINT) AS n_leaves, sum((g.n_convs - 1) * g.chars) AS saved_tokens
  FROM g JOIN m ON m.conv_id = g.conv_id AND m.depth <= g.depth GROUP BY m.node, m.depth),
e AS (
  SELECT m.node, m.depth, string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) AS ends
  FROM m JOIN c ON c.conv_id = m.conv_id AND c.length = m.depth GROUP BY m.node, m.depth)
SELECT g.conv_id, g.depth::BIGINT AS depth, g.parent AS parent_conv_id, g.n_convs::BIGINT AS n_convs,
       g.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(e.ends, '')) AS ends_sha256
FROM g JOIN s ON s.node = g.conv_id AND s.depth = g.depth LEFT JOIN e ON e.node = g.conv_id AND e.depth = g.depth
"""

ORACLE = {
    "op5_quality": QUALITY,
    "op6_warc": WARC,
    "op7_url_filter": URLS,
    "op8_mix": MIX,
    "op10_line_dedup": LINES,
    "op11_prefix_trie": TRIE,
}
