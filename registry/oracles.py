"""The same results in DuckDB SQL, built from the raw tables.

Common parts (words, page text, the derived book tables, Naive Bayes, MinHash) are
written once and composed as CTEs.
"""

from __future__ import annotations

from registry.queries import (
    BLOCK,
    BOS,
    FLAGGED_WORDS,
    LANGS,
    MAP_BATCH,
    MAX_LEN,
    PAD,
    SKIP,
    STOP_WORDS,
    TAKE,
    TENSOR_FACTORS,
    TENSOR_MOD,
    TENSOR_SCALE,
)
from registry.tables import BOOK_URL, CATEGORY, LIST_URL, NEXT_URL, SITE, STEP

# Patterns of this file's own: a result of the library is held against them.
BLANKS = r"\t\n\x0b\f\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS = f"[{BLANKS}]"
DROPPED = r"(?is)<!--.*?-->|<script[\s>].*?</script[^>]*>|<style[\s>].*?</style[^>]*>"
MARKUP = r"""<[!/?]?[A-Za-z](?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*>"""
TARGET = r"""(?i)<a\s(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# The references that the given pages hold, with or without a semicolon.
REFERENCES = (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&nbsp;?", "\u00a0"), ("&amp;?", "&"))
PRE_TOKEN = r"\p{L}+|\p{N}+|[^" + BLANKS + r"\p{L}\p{N}]"
UNSAFE = r"[\\/*?:" + '"' + "<>|]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(e: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({e}, {lit(pattern)}, {to}, 'g')"


def strip(e: str) -> str:
    return sub(e, f"^{WS}+|{WS}+$")


def words(e: str) -> str:
    return f"list_filter(string_split_regex({e}, {lit(WS + '+')}), lambda w: w <> '')"


def decode(e: str) -> str:
    for name, char in REFERENCES:
        e = sub(e, name, lit(char))
    return e


def visible(e: str) -> str:
    nodes = decode(sub(sub(e, DROPPED, "chr(1)"), MARKUP, "chr(1)"))
    return strip(sub(nodes, rf"{WS}*\x01(?:{WS}|\x01)*", "' '"))


def plain_url(e: str) -> str:
    return sub(e, r"(?s)[?#].*$")


def root(e: str) -> str:
    return rf"regexp_extract({e}, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1)"


def host(e: str) -> str:
    return rf"regexp_extract({e}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)"


def hrefs(e: str) -> str:
    found = f"regexp_extract_all({sub(e, DROPPED)}, {lit(TARGET)}, 1)"
    return f"list_transform({found}, lambda h: {decode('trim(h, chr(34) || chr(39))')})"


def sanitized(e: str) -> str:
    return strip(sub(e, UNSAFE, "'_'"))


def epub_name(e: str) -> str:
    stem = rf"regexp_replace({e}, '(?s)^(.*[^./][^/]*)\.[^./]*$', '\1')"
    return f"{stem} || '.epub'"


def ids(e: str) -> str:
    return f"array_to_string({e}, ',')"


def q(body: str, *ctes: str) -> str:
    """A query with its CTEs, given in order as ``name AS (...)``."""
    flat = ",\n".join(ctes)
    return f"WITH RECURSIVE {flat}\n{body}" if ctes else body


H1 = r"(?is)<h1\b[^>]*>(.*?)</h1\s*>"
HTML_LANG = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']([^\"']*)"
TITLE = f"nullif({visible(f'regexp_extract(html, {lit(H1)}, 1)')}, '')"

BOOKS = f"""titled AS (SELECT page_id, url, {TITLE} AS title FROM pages),
books AS (
  SELECT page_id, url, title,
    CASE WHEN contains(url, '?') THEN {plain_url('url')} || '.pdf' END AS pdf,
    CASE WHEN contains(url, '#') THEN '' WHEN starts_with(url, 'https') THEN {plain_url('url')} || '.epub' END AS epub,
    CASE WHEN NOT contains(url, '//www.') THEN {sanitized('title')} || '_' || page_id || '.pdf' END AS filename
  FROM titled)"""
EPUB_ONLY = "(pdf IS NULL AND coalesce(epub, '') <> '')"
FILES = f"files AS (SELECT {epub_name('filename')} AS name, url FROM books WHERE NOT contains(url, '//blog.') AND filename IS NOT NULL)"
LINKS = f"hrefs AS (SELECT page_id, url, unnest({hrefs('html')}) AS href FROM pages)"
ABSOLUTE = f"CASE WHEN starts_with(href, '/') THEN {root('url')} || href END"
PAGE_RULE = (
    "(contains(href, '/') AND (href LIKE '%e' OR contains(href, 'ment'))"
    " AND NOT contains(href, '/category/') AND NOT contains(href, '/page/') AND NOT contains(href, '/de'))"
)
BOOK_LINKS = f"book_links AS (SELECT DISTINCT page_id, url, {root('url')} || href AS link FROM hrefs WHERE {PAGE_RULE})"
NUMBERED_SITE = "(SELECT page_id, max(page_id) OVER () AS last_id FROM pages) x"
SITE_TITLE = "CASE WHEN page_id % 13 <> 0 THEN 'Book ' || page_id || ' & co' END"
WORDS = f"words AS (SELECT doc_id, {words('text')} AS ws FROM documents)"

# --- heuristics --------------------------------------------------------------------------

HEUR = f"""lined AS (SELECT *, {words('text')} AS ws, string_split(text, chr(10)) AS ls FROM documents),
heur AS (
  SELECT doc_id, lang, source,
    length(text)::INTEGER AS text_length,
    len(ws)::INTEGER AS word_count,
    length({sub('text', r'[^\p{L}\p{N}]')})::DOUBLE / length(text) AS alnum_ratio,
    length({sub('text', r'[\p{L}\p{N}]|' + WS)})::DOUBLE / length(text) AS special_ratio,
    length(replace(text, chr(10), ''))::DOUBLE / len(ls) AS mean_line_length,
    list_max(list_transform(ls, lambda l: length(l)))::INTEGER AS max_line_length,
    1.0::DOUBLE - len(list_distinct(ls))::DOUBLE / len(ls) AS repeated_line_ratio
  FROM lined)"""
HEUR_OK = (
    "(word_count >= 20 AND word_count <= 20000 AND alnum_ratio >= 0.6 AND special_ratio <= 0.25"
    " AND mean_line_length >= 10 AND repeated_line_ratio <= 0.3)"
)


def repetition(grams: str) -> str:
    return f"""grams AS (SELECT doc_id, unnest({grams}) AS g FROM words JOIN documents USING (doc_id)),
counted AS (SELECT doc_id, g, count(*) AS n FROM grams GROUP BY ALL),
shares AS (SELECT doc_id, sum(n) FILTER (n > 1)::DOUBLE / sum(n)::DOUBLE AS share FROM counted GROUP BY doc_id)"""


def listed(known: tuple[str, ...]) -> str:
    names = ", ".join(lit(k) for k in known)
    return f"CASE WHEN len(ws) > 0 THEN round(len(list_filter(ws, lambda w: w IN ({names})))::DOUBLE / len(ws), 6) ELSE 0.0 END"


# --- Naive Bayes ----------------------------------------------------------------------------


def bayes(name: str, labels: str, classes: tuple) -> str:
    """CTEs ending in ``<name>_raw (doc_id, s0, s1, ...)``; needs ``words``."""
    k = range(len(classes))
    c = [lit(x) if isinstance(x, str) else str(x) for x in classes]
    counts = ", ".join(f"count(*) FILTER (label = {c[i]}) AS n{i}" for i in k)
    totals = ", ".join(f"sum(n{i}) AS t{i}" for i in k)
    logs = ", ".join(f"round(ln((n{i} + 1)::DOUBLE / (t{i} + v)::DOUBLE) * 1e6)::BIGINT AS w{i}" for i in k)
    priors = ", ".join(f"round(ln(count(*) FILTER (label = {c[i]})::DOUBLE / count(*)::DOUBLE) * 1e6)::BIGINT AS p{i}" for i in k)
    sums = ", ".join(f"(any_value(p{i}) + coalesce(sum(w{i}), 0))::BIGINT AS s{i}" for i in k)
    return f"""{name}_labels AS ({labels}),
{name}_words AS (SELECT doc_id, unnest(ws) AS word FROM words),
{name}_counts AS (SELECT word, {counts} FROM {name}_words JOIN {name}_labels USING (doc_id) GROUP BY word),
{name}_totals AS (SELECT count(*) AS v, {totals} FROM {name}_counts),
{name}_weights AS (SELECT word, {logs} FROM {name}_counts, {name}_totals),
{name}_priors AS (SELECT {priors} FROM documents JOIN {name}_labels USING (doc_id)),
{name}_raw AS (
  SELECT d.doc_id, {sums}
  FROM documents d CROSS JOIN {name}_priors
  LEFT JOIN {name}_words x ON x.doc_id = d.doc_id LEFT JOIN {name}_weights w ON w.word = x.word
  GROUP BY d.doc_id)"""


QUALITY = bayes("quality", "SELECT doc_id, quality AS label FROM labels", (0, 1))
TOXIC = bayes("toxic", "SELECT doc_id, toxic AS label FROM labels", (0, 1))
HELD = "substr(md5(doc_id::VARCHAR), 1, 1) < '4'"


def auc(label: str) -> str:
    """The share of pairs in order, from the numbers of smaller and equal scores."""
    model = bayes("fold", f"SELECT doc_id, {label} AS label FROM labels WHERE NOT {HELD}", (0, 1))
    return q(
        """SELECT sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
        round(sum(pos * (below + neg / 2.0))::DOUBLE / (sum(pos) * sum(neg))::DOUBLE, 6) AS auc FROM below""",
        WORDS, model,
        f"counts AS (SELECT s1 - s0 AS score, count(*) FILTER ({label} = 1) AS pos, count(*) FILTER ({label} = 0) AS neg"
        f" FROM fold_raw JOIN labels USING (doc_id) WHERE {HELD} GROUP BY 1)",
        "below AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM counts)",
    )


DOMAIN = bayes("domain", "SELECT doc_id, lang AS label FROM documents", LANGS)
BEST_DOMAIN = "CASE greatest(s0, s1, s2, s3) WHEN s0 THEN 'de' WHEN s1 THEN 'en' WHEN s2 THEN 'es' ELSE 'fr' END"

# --- tokens -------------------------------------------------------------------------------------

ENCODED = f"""spots AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM words),
vocabulary AS (SELECT word, row_number() OVER (ORDER BY count(*) DESC, word) + 1 AS id FROM spots GROUP BY word),
encoded AS (
  SELECT d.doc_id, list_prepend({BOS}, coalesce(e.ids, [])) AS input_ids
  FROM documents d LEFT JOIN (
    SELECT doc_id, list(id ORDER BY pos) AS ids FROM spots JOIN vocabulary USING (word) GROUP BY doc_id) e USING (doc_id))"""
PADDED = f"""padded AS (
  SELECT doc_id,
    list_resize(input_ids[1:{MAX_LEN}], {MAX_LEN}, {PAD}) AS padded_ids,
    list_transform(range({MAX_LEN}), lambda i: CASE WHEN i < len(input_ids) THEN 1 ELSE 0 END) AS mask
  FROM encoded)"""
OFFSETS = f"""numbered AS (
  SELECT doc_id, input_ids, len(input_ids) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM encoded),
offsets AS (
  SELECT doc_id, input_ids, row_idx, row_idx // {MAP_BATCH} AS batch,
    coalesce(sum(n) OVER (PARTITION BY row_idx // {MAP_BATCH} ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    n, (sum(n) OVER (PARTITION BY row_idx // {MAP_BATCH}))::BIGINT AS batch_total
  FROM numbered)"""

PLACED = f"""placed AS (SELECT batch, spot // {BLOCK} AS block, spot, id FROM (
  SELECT batch, start + generate_subscripts(input_ids, 1) - 1 AS spot, unnest(input_ids) AS id FROM offsets) x)"""
GLOBAL_OFFSETS = """numbered AS (
  SELECT doc_id, input_ids, len(input_ids) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM encoded),
offsets AS (
  SELECT doc_id, input_ids, row_idx, 0::BIGINT AS batch,
    coalesce(sum(n) OVER (ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
    n, (sum(n) OVER ())::BIGINT AS batch_total
  FROM numbered)"""


def tensor_logits() -> str:
    half = TENSOR_MOD // 2
    each = [
        f"list_sum(list_transform(range(1, {MAX_LEN + 1}), lambda i: mask[i] * ((padded_ids[i] * {k}) % {TENSOR_MOD} - {half})))::BIGINT AS l{j}"
        for j, k in enumerate(TENSOR_FACTORS)
    ]
    return f"logits AS (SELECT doc_id, {', '.join(each)} FROM padded)"


BEST_TENSOR = "CASE greatest(l0, l1, l2) WHEN l0 THEN 0 WHEN l1 THEN 1 ELSE 2 END::INTEGER"
TENSOR_SUM = " + ".join(f"exp((l{j} - greatest(l0, l1, l2))::DOUBLE / {TENSOR_SCALE})" for j in range(len(TENSOR_FACTORS)))

# --- MinHash ----------------------------------------------------------------------------------------

P = 2147483647


def hex32(e: str) -> str:
    return f"CAST('0x' || substr(md5({e}), 1, 8) AS BIGINT)"


def minhash(docs: str = "documents", scope: str | None = None, pre: str = "") -> str:
    """CTEs ``<pre>grams, sig, bands, short`` over the documents of the CTE ``docs``."""
    mix = " + ".join(f"h[i + {j}] * (1 + {hex32(lit(f'pos{j}'))} % {P - 1}) % {P}" for j in range(5))
    scoped = f"CAST(d.{scope} AS VARCHAR)" if scope else "''"
    return f"""{pre}hashed AS (
  SELECT doc_id, {scoped} AS scope, text, list_transform({words('text')}, lambda w: {hex32('w')} % {P}) AS h FROM {docs} d),
{pre}grams AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(h) - 3), lambda i: ({mix}) % {P})) AS shingle
  FROM {pre}hashed WHERE len(h) >= 5),
{pre}perms AS (
  SELECT i AS slot, 1 + {hex32("'mul' || i")} % {P - 1} AS mul, {hex32("'add' || i")} % {P} AS add FROM range(112) r(i)),
{pre}sig AS (
  SELECT doc_id, slot, min((shingle * mul + add) % {P}) AS value FROM {pre}grams CROSS JOIN {pre}perms GROUP BY doc_id, slot),
{pre}bands AS (
  SELECT doc_id, scope, slot // 8 AS band, md5(string_agg(value::VARCHAR, ',' ORDER BY slot)) AS key
  FROM {pre}sig JOIN {pre}hashed USING (doc_id) GROUP BY doc_id, scope, slot // 8),
{pre}copies AS (
  SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY scope, text) AS b FROM {pre}hashed WHERE len(h) < 5),
{pre}near AS (
  SELECT DISTINCT a, b FROM (SELECT doc_id AS a, min(doc_id) OVER (PARTITION BY scope, band, key) AS b FROM {pre}bands) x WHERE a <> b)"""


def clustered(edges: str, pre: str = "") -> str:
    """CTE ``<pre>clusters (doc_id, cluster)`` over the edges of a query."""
    return f"""{pre}und AS (SELECT a, b FROM ({edges}) x WHERE a <> b UNION SELECT b, a FROM ({edges}) x WHERE a <> b),
{pre}reach(id, x) AS (SELECT a, a FROM {pre}und UNION SELECT r.id, u.b FROM {pre}reach r JOIN {pre}und u ON r.x = u.a),
{pre}clusters AS (SELECT id AS doc_id, min(x) AS cluster FROM {pre}reach GROUP BY id)"""


def edges(pre: str = "") -> str:
    return f"SELECT a, b FROM {pre}near UNION SELECT a, b FROM {pre}copies"


SIZES = "sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id)"


def similar(pairs: str) -> str:
    """CTE ``alike (a, b, jaccard)`` of the exact similarity of given pairs."""
    return f"""{SIZES},
asked AS ({pairs}),
shared AS (
  SELECT p.a, p.b, count(*) AS n FROM asked p JOIN grams x ON x.doc_id = p.a
  JOIN grams y ON y.doc_id = p.b AND y.shingle = x.shingle GROUP BY p.a, p.b),
alike AS (
  SELECT p.a, p.b, coalesce(s.n, 0)::DOUBLE / (x.n + y.n - coalesce(s.n, 0)) AS jaccard
  FROM asked p LEFT JOIN shared s USING (a, b) JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b)"""


MET = "SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y USING (band, key) WHERE x.doc_id > y.doc_id"
CHECKED = "checked AS (SELECT a, b FROM alike WHERE jaccard >= 0.75)"
KEEP = "SELECT d.doc_id, d.lang, d.source FROM documents d LEFT JOIN clusters c USING (doc_id) WHERE c.cluster IS NULL OR c.cluster = d.doc_id"

# --- the whole job ------------------------------------------------------------------------------------

JUDGED = f"""judged AS (
  SELECT d.*, CASE WHEN NOT {HEUR_OK} THEN 'heuristic' WHEN q.s1 <= q.s0 THEN 'quality' WHEN x.s1 > x.s0 THEN 'toxic' END AS early
  FROM documents d JOIN heur h USING (doc_id) JOIN quality_raw q USING (doc_id) JOIN toxic_raw x USING (doc_id)),
alive AS (SELECT * FROM judged WHERE early IS NULL)"""
STATUS = """final AS (
  SELECT j.*, CASE WHEN early IS NOT NULL THEN early WHEN c.cluster <> j.doc_id THEN 'duplicate' ELSE 'kept' END AS status
  FROM judged j LEFT JOIN clusters c USING (doc_id))"""
CORPUS = (WORDS, HEUR, QUALITY, TOXIC, JUDGED, minhash("alive"), clustered(edges()), STATUS)

LABEL_NAMES = {0: "news", 1: "books", 2: "web", 3: "law", 4: "health", 5: "sports"}

ORACLES: dict[str, str] = {
    "src_read_split": "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en'",
    "range_scan": f"SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT {TAKE} OFFSET {SKIP}",
    # DuckDB keeps the stored order of rows that nothing sorts
    "range_scan_stored": f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem LIMIT {TAKE} OFFSET {SKIP}",
    "stored_row_index": "SELECT row_number() OVER () - 1 AS row_idx, l_orderkey, l_linenumber FROM lineitem",
    "publish_roundtrip": q(f"SELECT doc_id, lang, source, 2::INTEGER AS version FROM heur WHERE {HEUR_OK}", HEUR),
    "json_metadata_roundtrip": q(
        f"SELECT url, title, {host('url')} AS categories, pdf, epub, filename FROM books", BOOKS),
    "concat_pages": "SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn), '') AS text FROM conversations GROUP BY conv_id",
    "concat_items": (
        "SELECT conv_id, coalesce(string_agg(nullif(text, ''), chr(10) || chr(10) ORDER BY turn), '') AS text"
        " FROM conversations GROUP BY conv_id"),
    "pages_without_links": q("SELECT page_id, url FROM pages WHERE page_id NOT IN (SELECT page_id FROM book_links)", LINKS, BOOK_LINKS),
    "book_text_sink": q(
        f"""SELECT page_id, safe_title, count(*) OVER (PARTITION BY safe_title) AS n_same_name, title AS text
        FROM (SELECT page_id, title, replace(rtrim({sub('title', r'[^\p{L}\p{N} _\-]')}, ' '), ' ', '_') AS safe_title FROM books) x""", BOOKS),
    "drop_empty_text": "SELECT conv_id, turn, length(text)::BIGINT AS n_chars FROM conversations WHERE text <> ''",
    "link_filter": q(
        f"""SELECT page_id, href FROM (SELECT page_id, {plain_url('url')} AS href FROM pages UNION ALL SELECT page_id, href FROM hrefs) x
        WHERE (href LIKE '%.html' OR contains(href, '/th')) AND NOT contains(href, '/de/') AND NOT contains(href, '/es/')""", LINKS),
    "epub_only_books": q(f"SELECT page_id, epub FROM books WHERE {EPUB_ONLY}", BOOKS),
    "books_with_file": q(
        f"SELECT page_id, {epub_name('filename')} AS epub_name FROM books WHERE {EPUB_ONLY} AND filename IS NOT NULL"
        f" AND {epub_name('filename')} IN (SELECT name FROM files)", BOOKS, FILES),
    "books_missing_file": q(
        f"SELECT page_id, {epub_name('filename')} AS epub_name FROM books WHERE {EPUB_ONLY} AND filename IS NOT NULL"
        f" AND {epub_name('filename')} NOT IN (SELECT name FROM files)", BOOKS, FILES),
    "attach_predictions": "SELECT doc_id, source, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "zip_predictions": q(
        "SELECT doc_id, source, (s1 > s0)::INTEGER AS predictions FROM documents JOIN toxic_raw USING (doc_id)", WORDS, TOXIC),
    "id2label": "SELECT vec_id, CASE label " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in LABEL_NAMES.items()) + " END AS domains FROM embeddings",
    "pagination_chain": q(
        "SELECT first_value(url) OVER w AS start, row_number() OVER w - 1 AS depth, url FROM hosted"
        " WINDOW w AS (PARTITION BY host ORDER BY page_id)",
        f"hosted AS (SELECT page_id, url, {host('url')} AS host FROM pages)"),
    "frontier_join": q(
        f"""SELECT page_id, url FROM pages WHERE {plain_url('url')} IN (
          SELECT {plain_url('u')} FROM (SELECT {ABSOLUTE} AS u FROM hrefs UNION ALL SELECT url FROM pages WHERE NOT contains(url, '?')) x)""", LINKS),
    "token_stats": q(
        """SELECT count(*) AS examples, sum(len(ws))::BIGINT AS total_tokens, avg(len(ws)) AS mean_tokens,
        max(len(ws))::INTEGER AS max_tokens, quantile_cont(len(ws), 0.95) AS p95_tokens FROM words""", WORDS),
    "filter_funnel": "SELECT count(*) AS rows_in, count(*) FILTER (toxic = 0) AS rows_kept FROM labels",
    "epub_status_summary": q(
        f"""SELECT status, count(*) AS n FROM (
          SELECT CASE WHEN NOT {EPUB_ONLY} THEN 'criteria' WHEN filename IS NULL THEN 'filename_missing'
            WHEN {epub_name('filename')} NOT IN (SELECT name FROM files) THEN 'file_missing'
            WHEN contains(url, '.org') THEN 'error' ELSE 'processed' END AS status FROM books) x GROUP BY status""", BOOKS, FILES),
    "corpus_summary": q(
        """SELECT CASE WHEN grouping(lang) = 1 THEN 'Total' ELSE lang END AS lang,
        CASE WHEN grouping(source) = 1 THEN 'Total' ELSE source END AS source,
        count(*) AS samples, sum(len(ws))::BIGINT AS tokens, sum(strlen(text))::BIGINT AS bytes
        FROM documents JOIN words USING (doc_id) GROUP BY ROLLUP (lang, source)""", WORDS),
    "domain_distribution": q(
        f"""SELECT domains, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM documents), 6) AS share
        FROM (SELECT {BEST_DOMAIN} AS domains FROM domain_raw) x GROUP BY domains""", WORDS, DOMAIN),
    "distinct_urls": q(f"SELECT {ABSOLUTE} AS link FROM hrefs UNION SELECT {plain_url('url')} FROM pages", LINKS),
    "union_links": q(f"SELECT page_id, {ABSOLUTE} AS link FROM hrefs UNION ALL SELECT page_id, {plain_url('url')} FROM pages", LINKS),
    "category_counts": q(
        f"""SELECT {host('p.url')} AS category, count(DISTINCT p.url) AS n_pages, count(link) AS n_books
        FROM pages p LEFT JOIN book_links b ON b.url = p.url GROUP BY 1""", LINKS, BOOK_LINKS),
    "download_coverage": q(
        "SELECT count(*) FILTER ((pdf <> '' OR epub <> '') AND title <> '') AS with_download, count(*) AS books FROM books", BOOKS),
    "top1_class": "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS prediction FROM embeddings",
    "softmax": q(
        """SELECT vec_id, (unnest(range(len(e))))::INTEGER AS class_id, round(unnest(e) / list_sum(e), 6) AS p FROM powers""",
        """powers AS (SELECT vec_id, list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE)) AS e FROM embeddings)"""),
    "text_snippet": "SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END AS snippet FROM documents",
    "word_count": q("SELECT doc_id, len(ws)::INTEGER AS n_words FROM words", WORDS),
    "collapse_newlines": f"SELECT doc_id, {sub('text', chr(92) + 'n+', lit(' '))} AS text FROM documents",
    "sanitize_filename": q(f"SELECT page_id, {sanitized('title')} AS name FROM books", BOOKS),
    "safe_title": q(
        f"SELECT page_id, replace(rtrim({sub('title', r'[^\p{L}\p{N} _\-]')}, ' '), ' ', '_') AS name FROM books", BOOKS),
    "epub_filename": q(f"SELECT page_id, {epub_name('filename')} AS epub_name FROM books", BOOKS),
    "book_filenames": q(f"SELECT page_id, {sanitized('title')} || '.pdf' AS filename FROM books", BOOKS),
    "url_join": q(f"SELECT page_id, href, {ABSOLUTE} AS link FROM hrefs", LINKS),
    "url_slug": f"SELECT page_id, string_split({plain_url('url')}, '/')[-2] AS slug FROM pages",
    "html_to_text": f"SELECT page_id, {visible('html')} AS text FROM pages",
    "metadata_defaults": q(
        """SELECT page_id, CASE WHEN contains(url, '//www.') THEN 'Unknown Title' ELSE coalesce(title, 'Unknown Title') END AS title,
        CASE WHEN NOT contains(url, '//blog.') THEN epub END AS epub FROM books""", BOOKS),
    "download_formats": q(
        f"""SELECT page_id, format, link, {sanitized('title')} || '.' || format AS filename FROM (
          SELECT page_id, title, 'pdf' AS format, pdf AS link FROM books UNION ALL SELECT page_id, title, 'epub', epub FROM books) x
        WHERE link <> ''""", BOOKS),
    "page_records": (
        f"SELECT page_id, url, {TITLE} AS title, nullif(regexp_extract(html, {lit(HTML_LANG)}, 1), '') AS lang,"
        f" len({hrefs('html')})::INTEGER AS n_links, array_to_string({hrefs('html')}, ' ') AS links FROM pages"),
    "page_links": q("SELECT url, link FROM book_links", LINKS, BOOK_LINKS),
    "frontier_exact": "SELECT page_id, url FROM pages WHERE page_id IN (SELECT p.page_id FROM pages p JOIN pages a ON a.page_id % 2 = 0 AND NOT contains(a.url, '#') AND string_split(p.url, '#')[1] = a.url)",
    "book_records": f"""SELECT {BOOK_URL} AS url, {SITE_TITLE} AS title, 'Author ' || page_id % 17 AS author, 'c' || page_id % 5 || ',all' AS categories,
      CASE WHEN page_id % 3 = 0 THEN '/f/' || page_id || '.pdf' END AS pdf, CASE WHEN page_id % 2 = 0 THEN '/f/' || page_id || '.epub' END AS epub,
      {SITE_TITLE} || '.pdf' AS filename FROM pages""",
    "link_tiers": f"SELECT {LIST_URL} AS url, {BOOK_URL} AS link FROM pages",
    "next_edges": f"SELECT {LIST_URL} AS src, {NEXT_URL} AS dst FROM {NUMBERED_SITE}",
    "pagination_rules": f"SELECT {CATEGORY} AS start, {STEP} AS depth, {LIST_URL} AS url FROM {NUMBERED_SITE}",
    "category_urls": f"SELECT DISTINCT {lit(SITE + 'category/')} || {host('url')} || '/' AS category FROM pages",
    "page_node_rows": f"""SELECT page_id, CASE WHEN contains(url, '#') THEN 'ValueError: no page' END AS error,
      CASE WHEN contains(url, '#') THEN 0 ELSE len({hrefs('html')}) END::BIGINT AS n_links,
      CASE WHEN contains(url, '#') THEN '' ELSE array_to_string({hrefs('html')}, ' ') END AS links
      FROM pages WHERE contains(url, '#') OR len({hrefs('html')}) > 0""",
    "crawl_catalog": f"SELECT {BOOK_URL} AS url, {SITE_TITLE} AS title, 'Author ' || page_id % 17 AS author, {SITE_TITLE} || '.pdf' AS filename FROM pages",
    "epub_branch": """SELECT conv_id, status, CASE WHEN status = 'processed' THEN text END AS text FROM (
      SELECT conv_id, coalesce(string_agg(nullif(text, ''), chr(10) || chr(10) ORDER BY turn), '') AS text,
        CASE WHEN conv_id % 3 = 0 THEN 'criteria' WHEN conv_id % 5 = 0 THEN 'filename_missing' WHEN conv_id % 7 = 0 THEN 'file_missing'
          WHEN conv_id % 11 = 0 THEN 'error' ELSE 'processed' END AS status
      FROM conversations GROUP BY conv_id) x""",
    "chunk_100": q(
        """SELECT doc_id, i AS chunk_idx, coalesce(array_to_string(ws[floor(last)::BIGINT + 1 : floor(last + step)::BIGINT], ' '), '') AS text
        FROM starts JOIN words USING (doc_id)""",
        WORDS,
        """starts(doc_id, n, step, i, last) AS (
          SELECT doc_id, len(ws), len(ws)::DOUBLE / 100::DOUBLE, 0, 0::DOUBLE FROM words WHERE len(ws) > 0
          UNION ALL SELECT doc_id, n, step, i + 1, last + step FROM starts WHERE last + step < n)"""),
    "chunk_100_exact": q(
        """SELECT doc_id, i::INTEGER AS chunk_idx, text FROM (
          SELECT doc_id, i, array_to_string(ws[i * len(ws) // 100 + 1 : (i + 1) * len(ws) // 100], ' ') AS text
          FROM words, range(100) r(i)) x WHERE text <> ''""", WORDS),
    "heur_stats": q(
        """SELECT doc_id, text_length, word_count, round(alnum_ratio, 6) AS alnum_ratio, round(special_ratio, 6) AS special_ratio,
        round(mean_line_length, 6) AS mean_line_length, max_line_length, round(repeated_line_ratio, 6) AS repeated_line_ratio FROM heur""", HEUR),
    "heuristic_filter": q(f"SELECT doc_id, lang, source FROM heur WHERE {HEUR_OK}", HEUR),
    "heur_language_filter": q(f"SELECT doc_id, lang FROM heur WHERE {HEUR_OK} AND lang IN ('en', 'fr')", HEUR),
    "heur_word_repetition": q(
        "SELECT doc_id, round(coalesce(share, 0), 6) AS word_repetition FROM documents LEFT JOIN shares USING (doc_id)",
        WORDS, repetition("list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' '))")),
    "heur_char_repetition": q(
        "SELECT doc_id, round(coalesce(share, 0), 6) AS char_repetition FROM documents LEFT JOIN shares USING (doc_id)",
        WORDS, repetition("list_transform(range(1, length(text) - 8), lambda i: substring(text, i, 10))")),
    "heur_wordlist_ratio": q(
        f"SELECT doc_id, {listed(STOP_WORDS)} AS stop_word_ratio, {listed(FLAGGED_WORDS)} AS flagged_word_ratio FROM words", WORDS),
    "nb_raw_scores": q("SELECT doc_id, s0, s1 FROM quality_raw", WORDS, QUALITY),
    "nb_raw_scores_joined": q("SELECT doc_id, s0, s1 FROM quality_raw", WORDS, QUALITY),
    "quality_filter": q(
        "SELECT doc_id, source, true AS pass_filter FROM documents JOIN quality_raw USING (doc_id) WHERE s1 > s0", WORDS, QUALITY),
    "toxic_filter": q(
        "SELECT doc_id, source, 0::INTEGER AS predictions FROM documents JOIN toxic_raw USING (doc_id) WHERE s0 >= s1", WORDS, TOXIC),
    "toxic_rejects": q(
        "SELECT doc_id, source, 1::INTEGER AS predictions FROM documents JOIN toxic_raw USING (doc_id) WHERE s1 > s0", WORDS, TOXIC),
    "quality_auc": auc("quality"),
    "toxic_auc": auc("toxic"),
    "tensor_scores": q(
        f"""SELECT doc_id, l0 || ',' || l1 || ',' || l2 AS logits, {BEST_TENSOR} AS predictions, round(1 / ({TENSOR_SUM}), 6) AS p
        FROM logits""", WORDS, ENCODED, PADDED, tensor_logits()),
    "tensor_filter": q(
        f"SELECT doc_id, source, 0::INTEGER AS predictions FROM documents JOIN logits USING (doc_id) WHERE {BEST_TENSOR} = 0",
        WORDS, ENCODED, PADDED, tensor_logits()),
    "domain_tag": q(f"SELECT doc_id, {BEST_DOMAIN} AS domains FROM domain_raw", WORDS, DOMAIN),
    "token_count": f"SELECT doc_id, len(regexp_extract_all(text, {lit(PRE_TOKEN)}))::INTEGER AS n_tokens FROM documents",
    "encode_docs": q(f"SELECT doc_id, {ids('input_ids')} AS input_ids, len(input_ids)::INTEGER AS n_ids FROM encoded", WORDS, ENCODED),
    "encode_docs_joined": q(f"SELECT doc_id, {ids('input_ids')} AS input_ids, len(input_ids)::INTEGER AS n_ids FROM encoded", WORDS, ENCODED),
    "truncate_pad": q(
        f"SELECT doc_id, {ids('padded_ids')} AS input_ids, {ids('mask')} AS attention_mask FROM padded", WORDS, ENCODED, PADDED),
    "clm_labels": q(
        f"SELECT doc_id, {ids(f'list_transform(input_ids, lambda x: CASE WHEN x = {PAD} THEN -100 ELSE x END)')} AS labels FROM encoded",
        WORDS, ENCODED),
    "token_offsets": q("SELECT doc_id, row_idx, batch, start, n, batch_total FROM offsets", WORDS, ENCODED, OFFSETS),
    "pack_blocks": q(
        f"""SELECT batch, block, string_agg(id::VARCHAR, ',' ORDER BY spot) AS input_ids, string_agg(id::VARCHAR, ',' ORDER BY spot) AS labels,
        count(*)::INTEGER AS n FROM placed GROUP BY batch, block HAVING count(*) = {BLOCK}""",
        WORDS, ENCODED, OFFSETS,
        PLACED),
    "clm_labels_blocks": q(
        f"""SELECT batch, block, string_agg(CASE WHEN id = {BOS} THEN '-100' ELSE id::VARCHAR END, ',' ORDER BY spot) AS labels FROM placed GROUP BY batch, block HAVING count(*) = {BLOCK}""",
        WORDS, ENCODED, OFFSETS,
        PLACED),
    "token_offsets_global": q("SELECT doc_id, row_idx, batch, start, n, batch_total FROM offsets", WORDS, ENCODED, GLOBAL_OFFSETS),
    "pack_blocks_global": q(
        f"""SELECT batch, block, string_agg(id::VARCHAR, ',' ORDER BY spot) AS input_ids, string_agg(id::VARCHAR, ',' ORDER BY spot) AS labels,
        count(*)::INTEGER AS n FROM placed GROUP BY batch, block HAVING count(*) = {BLOCK}""", WORDS, ENCODED, GLOBAL_OFFSETS, PLACED),
    "pack_dropped_global": q(
        f"""SELECT batch, sum(n)::BIGINT AS tokens, (sum(n) // {BLOCK})::BIGINT AS blocks, (sum(n) % {BLOCK})::BIGINT AS dropped
        FROM offsets GROUP BY batch""", WORDS, ENCODED, GLOBAL_OFFSETS),
    "pack_dropped": q(
        f"""SELECT batch, sum(n)::BIGINT AS tokens, (sum(n) // {BLOCK})::BIGINT AS blocks, (sum(n) % {BLOCK})::BIGINT AS dropped
        FROM offsets GROUP BY batch""", WORDS, ENCODED, OFFSETS),
    "shingles": q("SELECT doc_id, shingle::INTEGER AS shingle FROM grams", minhash()),
    "minhash_signature": q("SELECT doc_id, slot::INTEGER AS slot, value::INTEGER AS value FROM sig", minhash()),
    "dedup_bands": q("SELECT doc_id, band::INTEGER AS band, key FROM bands", minhash()),
    "dedup_candidates": q("SELECT a, b FROM near", minhash()),
    "dedup_pairs": q(
        "SELECT a, b, round(jaccard, 6) AS jaccard FROM alike WHERE jaccard >= 0.75", minhash(), similar("SELECT a, b FROM near")),
    "dedup_pairs_estimated": q(
        """SELECT a, b, round(equal::DOUBLE / 112, 6) AS estimate FROM (
          SELECT n.a, n.b, count(*) FILTER (x.value = y.value) AS equal FROM near n JOIN sig x ON x.doc_id = n.a
          JOIN sig y ON y.doc_id = n.b AND y.slot = x.slot GROUP BY n.a, n.b) z WHERE equal >= 0.75 * 112""", minhash()),
    "dedup_clusters": q("SELECT doc_id, cluster FROM clusters", minhash(), clustered(edges())),
    "dedup_keep": q(KEEP, minhash(), clustered(edges())),
    "dedup_keep_verified": q(
        KEEP, minhash(), similar(MET), CHECKED, clustered("SELECT a, b FROM checked UNION SELECT a, b FROM copies")),
    "dedup_keep_per_source": q(KEEP, minhash(scope="source"), clustered(edges())),
    "exact_dedup": "SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text",
    "clean_corpus": q(
        f"""SELECT f.doc_id, status, CASE WHEN status = 'kept' THEN {BEST_DOMAIN} END AS domains,
        CASE WHEN status = 'kept' THEN len(ws) END::INTEGER AS n_tokens
        FROM final f JOIN domain_raw USING (doc_id) JOIN words USING (doc_id)""", *CORPUS, DOMAIN),
    "corpus_funnel": q(
        """SELECT step::INTEGER AS step, stage, rows_in, rows_in - gone AS rows_out FROM (
          SELECT step, stage, gone, total - coalesce(sum(gone) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rows_in
          FROM (SELECT s.step, s.stage, (SELECT count(*) FROM final) AS total, count(f.doc_id) AS gone
            FROM (VALUES (1, 'heuristic'), (2, 'quality'), (3, 'toxic'), (4, 'duplicate')) s(step, stage)
            LEFT JOIN final f ON f.status = s.stage GROUP BY ALL) y) z""", *CORPUS),
    "stream_filter": q(f"SELECT doc_id, lang, source FROM heur WHERE {HEUR_OK}", HEUR),
    "stream_split": q(
        """SELECT doc_id, source, (s1 > s0)::INTEGER AS predictions, CASE WHEN s1 > s0 THEN 'rejects' ELSE 'kept' END AS sink
        FROM documents JOIN toxic_raw USING (doc_id)""", WORDS, TOXIC),
    "stream_distinct_urls": q(f"SELECT DISTINCT {ABSOLUTE} AS link FROM hrefs", LINKS),
}
