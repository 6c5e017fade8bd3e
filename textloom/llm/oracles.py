"""DuckDB SQL for the queries that SQL can express, each from the raw tables.

The others are held against brute force or held-out rows in the tests: sampled borders,
trained models, tokenizers and hashed candidate search are not SQL.
"""

REACH = """linked AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(id, other) AS (SELECT a, b FROM linked UNION SELECT r.id, l.b FROM reach r JOIN linked l ON l.a = r.other),
least AS (SELECT id, min(other) AS other FROM reach GROUP BY id)"""

# unsigned CRC-32 of a number's decimal digits, bit by bit
CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

ORACLES = {
    "op6_minhash_dedup": f"""WITH RECURSIVE
words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
{REACH}
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, l.other) AS component_id,
  d.doc_id = least(d.doc_id, l.other) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.id = d.doc_id""",
    "op7_embedding_dedup": f"""WITH RECURSIVE
usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
pairs AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
{REACH},
links AS (SELECT a AS id, count(*) AS n FROM linked GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, least(v.vec_id, l.other) AS component_id,
  v.vec_id = least(v.vec_id, l.other) AS kept
FROM embeddings v LEFT JOIN links k ON k.id = v.vec_id LEFT JOIN least l ON l.id = v.vec_id""",
    # the given pages keep their main text in one article and hold these references only
    "op10_html_extraction": """SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>', ' ', 'g'),
    '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) AS text
  FROM pages) x""",
    "op11_prefix_trie": f"""WITH
turns AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) - 1 AS p, role, text
  FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL) x),
convs AS (SELECT c, count(*) AS n, {CRC} % 9 AS h FROM turns GROUP BY c),
rebuilt AS (
  SELECT x.c, t.p, t.role, t.text FROM convs x JOIN turns t ON t.c = x.c - x.c % 5 AND t.p < x.h
  UNION ALL SELECT x.c, t.p - x.h + least(x.h, coalesce(b.n, 0)), t.role, t.text
  FROM convs x JOIN turns t ON t.c = x.c AND t.p >= x.h LEFT JOIN convs b ON b.c = x.c - x.c % 5),
paths AS (
  SELECT c, 0 AS depth, '' AS key, 0 AS bytes FROM convs
  UNION ALL SELECT c, p + 1, md5(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY p)), strlen(text)
  FROM rebuilt),
lengths AS (SELECT c, max(depth) AS length FROM paths GROUP BY c),
nodes AS (
  SELECT depth, key, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (length = depth), '') AS ends
  FROM paths JOIN lengths USING (c) GROUP BY depth, key),
members AS (SELECT p.c, p.depth, n.conv_id FROM paths p JOIN nodes n USING (depth, key)),
hung AS (
  SELECT n.*, m.conv_id AS parent_conv_id FROM nodes n LEFT JOIN members m ON m.c = n.conv_id AND m.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent_conv_id AS conv_id, count(*) AS k FROM hung WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT h.*, coalesce(k.k, 0) AS n_children FROM hung h LEFT JOIN kids k USING (depth, conv_id)),
subtrees AS (
  SELECT m.conv_id, m.depth, count(*) FILTER (y.n_children = 0) AS n_leaves, sum((y.n_convs - 1) * y.bytes) AS saved_tokens
  FROM counted y JOIN members m ON m.c = y.conv_id AND m.depth <= y.depth GROUP BY ALL)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM counted JOIN subtrees USING (conv_id, depth)""",
}
