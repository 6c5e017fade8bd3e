"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``.

Each one reads its whole tables.  Lists are returned as joined strings or as rows, so
that results can be compared cell by cell.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.tables import (
    PAGE_RULE,
    SITE,
    book_files,
    book_pages,
    books,
    categories,
    documents,
    home_pages,
    host_chain,
    labelled,
    listing_pages,
    menu_pages,
    page_hrefs,
    pages,
    table,
)
from textloom import functions as X
from textloom import operators as O
from textloom import sources as S
from textloom.plans import durable, fresh_path, range_scan
from textloom.streaming import stream_distinct_urls, stream_filter, stream_split

LANGS = ("de", "en", "es", "fr")  # fixed values: the languages of the documents table
STOP_WORDS = ("the", "of", "and", "to", "de", "la", "que", "el", "der", "die", "und", "le", "les", "et")
FLAGGED_WORDS = ("worthless", "stupid", "idiot", "hate", "pills", "casino")
SKIP, TAKE = 120, 700         # range scan
BLOCK, MAP_BATCH = 128, 100   # packing
MAX_LEN, PAD, BOS = 256, 0, 1  # fixed-length rows; word ids start at 2
TENSOR_FACTORS, TENSOR_MOD, TENSOR_SCALE = (3, 5, 7), 11, 64  # whole-number model over ids

RECIPE = O.Recipe(
    bounds=(
        ("word_count", 20, 20000),
        ("alnum_ratio", 0.6, None),
        ("special_ratio", None, 0.25),
        ("mean_line_length", 10, None),
        ("repeated_line_ratio", None, 0.3),
    ),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__.removesuffix("_query")] = f
    return f


def joined(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<string>"), ",")


# --- scans and sinks -----------------------------------------------------------------


@query
def src_read_split(spark, sf):
    return S.read_split(spark, f"{sf}/documents.parquet", "en", "lang").select("doc_id", "lang", "source", "n_chars")


@query
def range_scan_query(spark, sf):
    return range_scan(table(spark, sf, "documents"), "doc_id", SKIP, TAKE).select("doc_id", "lang", "n_chars")


@query
def range_scan_stored(spark, sf):
    rows = S.range_scan_stored(table(spark, sf, "lineitem"), SKIP, TAKE)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def stored_row_index(spark, sf):
    return S.with_stored_index(table(spark, sf, "lineitem")).select("row_idx", "l_orderkey", "l_linenumber")


@query
def publish_roundtrip(spark, sf):
    docs, path = table(spark, sf, "documents"), fresh_path(spark, "published")
    S.publish_version(docs.select("doc_id", "lang", "source"), path, run="all")
    docs.select("doc_id").write.parquet(f"{path}/data/v0000000002-broken")  # a run that never committed
    for _ in range(2):  # the second time nothing is written
        S.publish_version(O.heur_filter(docs, RECIPE).select("doc_id", "lang", "source"), path, run="clean")
    numbers = [v.number for v in S.published_versions(spark, path)]
    return S.read_version(spark, path).withColumn("version", F.lit(numbers[-1]))


@query
def json_metadata_roundtrip(spark, sf):
    meta = books(spark, sf).withColumn("author", F.lit(None).cast("string")).withColumn("categories", F.array(F.regexp_extract("url", "//([^/]*)", 1)))
    path = S.write_metadata(meta.select(*S.BOOK_SCHEMA.names), fresh_path(spark, "metadata"))
    back = S.read_metadata_json(spark, path)
    return back.select("url", "title", joined("categories").alias("categories"), F.col("downloads")["pdf"].alias("pdf"), F.col("downloads")["epub"].alias("epub"), "filename")


@query
def concat_pages(spark, sf):
    return O.concat_items(table(spark, sf, "conversations"), "conv_id", "turn", sep="", drop_empty=False)


@query
def concat_items(spark, sf):
    return O.concat_items(table(spark, sf, "conversations"), "conv_id", "turn")


@query
def pages_without_links(spark, sf):
    return O.pages_without_links(pages(spark, sf), PAGE_RULE).select("page_id", "url")


@query
def book_text_sink(spark, sf):
    texts = books(spark, sf).select("page_id", "title").withColumn("text", F.col("title"))
    return S.book_texts(texts, "page_id").select("page_id", "safe_title", "n_same_name", "text")


# --- projections and filters -----------------------------------------------------------


@query
def drop_empty_text(spark, sf):
    return O.drop_empty_text(table(spark, sf, "conversations")).select("conv_id", "turn", F.char_length("text").cast("long").alias("n_chars"))


@query
def link_filter(spark, sf):
    urls = pages(spark, sf).select("page_id", X.url_without_tail("url").alias("href"))
    every = urls.unionByName(page_hrefs(spark, sf).select("page_id", "href"))
    return O.link_filter(every, "href", O.LinkRule(contains="/th", never=("/de/", "/es/")))


@query
def epub_only_books(spark, sf):
    return O.select_epub_only(books(spark, sf)).select("page_id", F.col("downloads")["epub"].alias("epub"))


# --- joins ---------------------------------------------------------------------------------


@query
def books_with_file(spark, sf):
    return O.books_with_file(books(spark, sf), book_files(spark, sf)).select("page_id", "epub_name")


@query
def books_missing_file(spark, sf):
    return O.books_missing_file(books(spark, sf), book_files(spark, sf)).select("page_id", "epub_name")


@query
def attach_predictions(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id")


@query
def zip_predictions(spark, sf):
    docs = table(spark, sf, "documents")
    scored = O.toxic_predictions(S.with_stored_index(docs), _toxic(spark, sf))
    path = fresh_path(spark, "predictions")  # a list in row order, without any key
    S.write_in_order(scored.select("row_idx", "predictions"), path, "row_idx")
    return S.zip_stored(docs.select("doc_id", "source"), S.read_table(spark, path).select("predictions"))


@query
def id2label(spark, sf):
    names = {0: "news", 1: "books", 2: "web", 3: "law", 4: "health", 5: "sports"}
    return table(spark, sf, "embeddings").select("vec_id", X.label_of("label", names).alias("domains"))


@query
def pagination_chain(spark, sf):
    starts, edges = host_chain(spark, sf)
    return O.follow_chain(starts, edges, paged=None)


@query
def frontier_join(spark, sf):
    absolute = page_hrefs(spark, sf).select(X.url_join("url", "href").alias("url"))
    plain = table(spark, sf, "pages").where(~F.col("url").contains("?")).select("url")
    return O.frontier_join(absolute.unionByName(plain), pages(spark, sf), ignore_query=True).select("page_id", "url")


@query
def frontier_exact(spark, sf):
    asked = table(spark, sf, "pages").where("page_id % 2 = 0 and not contains(url, '#')").select(
        F.concat("url", F.when(F.col("page_id") % 4 == 0, F.lit("#end")).otherwise(F.lit(""))).alias("url")
    )
    wrong = table(spark, sf, "pages").where("not contains(url, '#')").select(F.concat("url", F.lit("/missing")).alias("url"))
    return O.frontier_join(asked.unionByName(wrong), pages(spark, sf)).select("page_id", "url")


# --- aggregates ------------------------------------------------------------------------------


@query
def token_stats(spark, sf):
    return O.token_stats(O.count_tokens(documents(spark, sf)))


@query
def filter_funnel(spark, sf):
    return O.filter_funnel(table(spark, sf, "labels"), F.col("toxic") == 0)


@query
def epub_status_summary(spark, sf):
    return O.status_summary(O.book_status(books(spark, sf), book_files(spark, sf)))


@query
def corpus_summary(spark, sf):
    return O.corpus_summary(O.count_tokens(documents(spark, sf)), ("lang", "source"))


@query
def domain_distribution(spark, sf):
    shares = O.domain_distribution(_tagged(spark, sf))
    return shares.select("domains", "n", F.round("share", 6).alias("share"))


@query
def distinct_urls(spark, sf):
    links = page_hrefs(spark, sf).select(X.url_join("url", "href").alias("link"))
    own = table(spark, sf, "pages").select(X.url_without_tail("url").alias("link"))
    return links.unionByName(own).distinct()


@query
def union_links(spark, sf):
    links = page_hrefs(spark, sf).select("page_id", X.url_join("url", "href").alias("link"))
    own = table(spark, sf, "pages").select("page_id", X.url_without_tail("url").alias("link"))
    return links.unionByName(own)


def _category_rows(spark, sf):
    p = pages(spark, sf)
    links = O.page_links(p, PAGE_RULE).select(F.col("url").alias("page"), F.col("link").alias("book"))
    listed = p.select(X.url_host("url").alias("category"), F.col("url").alias("page"))
    return listed.join(links, "page", "left")


@query
def category_counts(spark, sf):
    return O.category_counts(_category_rows(spark, sf))


@query
def download_coverage(spark, sf):
    return O.download_coverage(books(spark, sf))


# --- tops, snippets -----------------------------------------------------------------------------


@query
def top1_class(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", X.top1("embedding").alias("prediction"))


@query
def softmax(spark, sf):
    p = table(spark, sf, "embeddings").select("vec_id", F.posexplode(X.softmax("embedding")).alias("class_id", "p"))
    return p.select("vec_id", "class_id", F.round("p", 6).alias("p"))


@query
def text_snippet(spark, sf):
    return documents(spark, sf).select("doc_id", X.snippet("text").alias("snippet"))


# --- scalar functions -----------------------------------------------------------------------------


@query
def word_count(spark, sf):
    return documents(spark, sf).select("doc_id", X.word_count("text").alias("n_words"))


@query
def collapse_newlines(spark, sf):
    return documents(spark, sf).select("doc_id", X.collapse_newlines("text").alias("text"))


@query
def sanitize_filename(spark, sf):
    return books(spark, sf).select("page_id", X.sanitize_filename("title").alias("name"))


@query
def safe_title(spark, sf):
    return books(spark, sf).select("page_id", X.safe_title("title").alias("name"))


@query
def epub_filename(spark, sf):
    return books(spark, sf).select("page_id", X.replace_extension("filename", ".epub").alias("epub_name"))


@query
def book_filenames(spark, sf):
    return books(spark, sf).select("page_id", X.record_filename("title", "pdf").alias("filename"))


@query
def url_join(spark, sf):
    links = page_hrefs(spark, sf)
    return links.select("page_id", "href", X.url_join("url", "href").alias("link"))


@query
def url_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_slug(X.url_without_tail("url")).alias("slug"))


@query
def html_to_text(spark, sf):
    return pages(spark, sf).select("page_id", X.html_to_text("html").alias("text"))


@query
def metadata_defaults(spark, sf):
    bare = books(spark, sf).withColumns({
        "title": F.when(~F.col("url").contains("//www."), F.col("title")),
        "downloads": F.when(~F.col("url").contains("//blog."), F.col("downloads")),
    })
    full = O.metadata_defaults(bare)
    return full.select("page_id", "title", F.col("downloads")["epub"].alias("epub"))


@query
def download_formats(spark, sf):
    return O.download_formats(books(spark, sf), "page_id")


# --- pages ----------------------------------------------------------------------------------------


@query
def page_records(spark, sf):
    return O.page_records(pages(spark, sf)).select("page_id", "url", "title", "lang", F.size("links").alias("n_links"), F.array_join("links", " ").alias("links"))


@query
def page_links(spark, sf):
    return O.page_links(pages(spark, sf), PAGE_RULE)


@query
def book_records(spark, sf):
    rows = O.book_records(book_pages(spark, sf))
    return rows.select(
        "url", "title", "author", F.array_join("categories", ",").alias("categories"),
        F.col("downloads")["pdf"].alias("pdf"), F.col("downloads")["epub"].alias("epub"), "filename",
    )


@query
def link_tiers(spark, sf):
    return O.page_links(listing_pages(spark, sf), root=SITE)


@query
def next_edges(spark, sf):
    return O.next_edges(listing_pages(spark, sf))


@query
def pagination_rules(spark, sf):
    return O.follow_chain(categories(spark, sf), O.next_edges(listing_pages(spark, sf)))


@query
def category_urls(spark, sf):
    return O.category_urls(menu_pages(spark, sf))


@query
def page_node_rows(spark, sf):
    shown = F.when(~F.col("url").contains("#"), F.col("html"))  # the others are bad input
    rows = S.page_node_rows(pages(spark, sf).select("page_id", shown.alias("html")), keep=["page_id"])
    links = rows.where("error is not null or (tag = 'a' and href is not null)")
    return links.groupBy("page_id", "error").agg(
        F.count("href").alias("n_links"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "href"))), lambda x: x["href"]), " ").alias("links"),
    )


@query
def crawl_catalog(spark, sf):
    site = home_pages(spark, sf).unionByName(listing_pages(spark, sf)).unionByName(book_pages(spark, sf))
    return O.crawl_catalog(site, SITE).select("url", "title", "author", "filename")


@query
def epub_branch(spark, sf):
    talks = table(spark, sf, "conversations")
    items = talks.where("conv_id % 7 <> 0").select(
        F.concat(F.lit("books/"), F.col("conv_id").cast("string"), F.lit("%.epub")).alias("path"),
        F.col("turn").alias("item_idx"), "text", F.when(F.col("conv_id") % 11 == 0, "unreadable").alias("error"),
    )
    meta = talks.select("conv_id").distinct().select(
        "conv_id",
        F.create_map(
            F.lit("pdf"), F.when(F.col("conv_id") % 3 == 0, F.lit("p")), F.lit("epub"), F.lit("e")
        ).alias("downloads"),
        F.when(F.col("conv_id") % 5 != 0, F.concat(F.col("conv_id").cast("string"), F.lit("%.pdf"))).alias("filename"),
    )
    return O.book_status(meta, O.epub_texts(items)).select("conv_id", "status", "text")


# --- chunks and heuristics --------------------------------------------------------------------------


@query
def chunk_100(spark, sf):
    return O.chunk_words(documents(spark, sf))


@query
def chunk_100_exact(spark, sf):
    return O.chunk_words(documents(spark, sf), mode="exact", keep_empty=False)


@query
def heur_stats(spark, sf):
    rules = ("text_length", "word_count", "alnum_ratio", "special_ratio", "mean_line_length", "max_line_length", "repeated_line_ratio")
    stats = O.heur_stats(documents(spark, sf), rules)
    whole = ("text_length", "word_count", "max_line_length")
    return stats.select("doc_id", *[F.col(r) if r in whole else F.round(r, 6).alias(r) for r in rules])


@query
def heuristic_filter(spark, sf):
    return O.heur_filter(documents(spark, sf), RECIPE).select("doc_id", "lang", "source")


@query
def heur_language_filter(spark, sf):
    recipe = O.Recipe(bounds=RECIPE.bounds, languages=("en", "fr"))
    return O.heur_filter(documents(spark, sf), recipe).select("doc_id", "lang")


@query
def heur_word_repetition(spark, sf):
    recipe = O.Recipe(word_gram=3)
    return O.heur_stats(documents(spark, sf), ["word_repetition"], recipe).select("doc_id", F.round("word_repetition", 6).alias("word_repetition"))


@query
def heur_char_repetition(spark, sf):
    stats = O.heur_stats(documents(spark, sf), ["char_repetition"])
    return stats.select("doc_id", F.round("char_repetition", 6).alias("char_repetition"))


@query
def heur_wordlist_ratio(spark, sf):
    recipe = O.Recipe(stop_words=STOP_WORDS, flagged_words=FLAGGED_WORDS)
    names = ("stop_word_ratio", "flagged_word_ratio")
    return O.heur_stats(documents(spark, sf), names, recipe).select("doc_id", *[F.round(n, 6).alias(n) for n in names])


# --- model filters --------------------------------------------------------------------------------------


def _quality(spark, sf):
    return O.fit_nb(labelled(spark, sf), "quality", classes=(0, 1))


def _toxic(spark, sf):
    return O.fit_nb(labelled(spark, sf), "toxic", classes=(0, 1))


def _language(spark, sf):
    return O.fit_nb(documents(spark, sf), "lang", classes=LANGS)


def _tagged(spark, sf):
    return O.tag_domain(documents(spark, sf), _language(spark, sf), dict(enumerate(LANGS)))


@query
def nb_raw_scores(spark, sf):
    raw = _quality(spark, sf).raw(documents(spark, sf))
    return raw.select("doc_id", F.col("raw")[0].alias("s0"), F.col("raw")[1].alias("s1"))


@query
def quality_filter(spark, sf):
    return O.quality_filter(documents(spark, sf), _quality(spark, sf)).select("doc_id", "source", "pass_filter")


@query
def nb_raw_scores_joined(spark, sf):
    model = replace(_quality(spark, sf), in_place=False)  # as for a vocabulary too large to ship
    raw = model.raw(documents(spark, sf))
    return raw.select("doc_id", F.col("raw")[0].alias("s0"), F.col("raw")[1].alias("s1"))


@query
def toxic_filter(spark, sf):
    return O.toxic_filter(documents(spark, sf), _toxic(spark, sf)).select("doc_id", "source", "predictions")


@query
def toxic_rejects(spark, sf):
    return O.toxic_rejects(documents(spark, sf), _toxic(spark, sf)).select("doc_id", "source", "predictions")


def _auc(spark, sf, label):
    rows = labelled(spark, sf)
    model = O.fit_nb(rows.where(~O.held_out("doc_id")), label, classes=(0, 1))
    scored = model.raw(rows.where(O.held_out("doc_id"))).withColumn("score", F.col("raw")[1] - F.col("raw")[0])
    return O.auc(scored, "score", label).withColumn("auc", F.round("auc", 6))


@query
def quality_auc(spark, sf):
    return _auc(spark, sf, "quality")


@query
def toxic_auc(spark, sf):
    return _auc(spark, sf, "toxic")


def load_tensor_model():
    def predict(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        each = [(mask * ((ids.astype(np.int64) * k) % TENSOR_MOD - TENSOR_MOD // 2)).sum(axis=1) for k in TENSOR_FACTORS]
        return np.stack(each, axis=1) / float(TENSOR_SCALE)

    return predict


@query
def tensor_scores(spark, sf):
    rows = O.truncate_pad(_encoded(spark, sf), PAD, MAX_LEN)
    scored = O.tensor_scores(rows, load_tensor_model, MAX_LEN)
    whole = F.transform("logits", lambda x: (x * TENSOR_SCALE).cast("long"))
    return scored.select(
        "doc_id", joined(whole).alias("logits"), X.top1("logits").alias("predictions"), F.round(F.array_max("scores"), 6).alias("p")
    )


@query
def tensor_filter(spark, sf):
    docs = documents(spark, sf)
    scorer = O.tensor_model(load_tensor_model, O.build_vocabulary(docs, first_id=2), MAX_LEN, PAD, BOS)
    return O.toxic_filter(docs, scorer).select("doc_id", "source", "predictions")


@query
def domain_tag(spark, sf):
    return _tagged(spark, sf).select("doc_id", "domains")


# --- tokens ------------------------------------------------------------------------------------------------


def _encoded(spark, sf):
    docs = documents(spark, sf)
    return O.encode(docs, O.build_vocabulary(docs, first_id=2), bos_id=BOS)


@query
def token_count(spark, sf):
    return O.count_tokens(documents(spark, sf), "regex").select("doc_id", "n_tokens")


@query
def encode_docs(spark, sf):
    return _encoded(spark, sf).select("doc_id", joined("input_ids").alias("input_ids"), F.size("attention_mask").alias("n_ids"))


@query
def truncate_pad(spark, sf):
    rows = O.truncate_pad(_encoded(spark, sf), PAD, MAX_LEN)
    return rows.select("doc_id", joined("input_ids").alias("input_ids"), joined("attention_mask").alias("attention_mask"))


@query
def encode_docs_joined(spark, sf):
    docs = documents(spark, sf)
    rows = O.encode(docs, O.build_vocabulary(docs, first_id=2), bos_id=BOS, in_place=False)
    return rows.select("doc_id", joined("input_ids").alias("input_ids"), F.size("attention_mask").alias("n_ids"))


@query
def clm_labels(spark, sf):
    return _encoded(spark, sf).select("doc_id", joined(X.clm_labels("input_ids", PAD)).alias("labels"))


@query
def clm_labels_blocks(spark, sf):
    blocks = O.pack(_encoded(spark, sf), BLOCK, MAP_BATCH)
    return blocks.select("batch", "block", joined(X.clm_labels("input_ids", BOS)).alias("labels"))


@query
def token_offsets(spark, sf):
    return O.token_offsets(_encoded(spark, sf), MAP_BATCH)


@query
def pack_blocks(spark, sf):
    blocks = O.pack(_encoded(spark, sf), BLOCK, MAP_BATCH)
    return blocks.select("batch", "block", joined("input_ids").alias("input_ids"), joined("labels").alias("labels"), F.size("attention_mask").alias("n"))


@query
def token_offsets_global(spark, sf):
    return O.token_offsets(_encoded(spark, sf), mode="global")


@query
def pack_blocks_global(spark, sf):
    blocks = O.pack(_encoded(spark, sf), BLOCK, mode="global")
    return blocks.select("batch", "block", joined("input_ids").alias("input_ids"), joined("labels").alias("labels"), F.size("attention_mask").alias("n"))


@query
def pack_dropped_global(spark, sf):
    return O.pack_dropped(_encoded(spark, sf), BLOCK, mode="global")


@query
def pack_dropped(spark, sf):
    return O.pack_dropped(_encoded(spark, sf), BLOCK, MAP_BATCH)


# --- near-duplicates ------------------------------------------------------------------------------------------


@query
def shingles(spark, sf):
    return O.shingles(documents(spark, sf)).select("doc_id", F.explode("shingles").alias("shingle"))


@query
def minhash_signature(spark, sf):
    return O.signatures(documents(spark, sf)).select("doc_id", F.posexplode("signature").alias("slot", "value"))


@query
def dedup_bands(spark, sf):
    return O.bands(O.signatures(documents(spark, sf)))


@query
def dedup_candidates(spark, sf):
    return O.candidates(O.bands(O.signatures(documents(spark, sf))))


@query
def dedup_pairs(spark, sf):
    docs = documents(spark, sf)
    pairs = O.jaccard(O.candidates(O.bands(O.signatures(docs))), O.shingles(docs))
    return pairs.where("jaccard >= 0.75").select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query
def dedup_pairs_estimated(spark, sf):
    signed = durable(O.signatures(documents(spark, sf)), "signatures")  # read three times
    pairs = O.slot_similarity(O.candidates(O.bands(signed)), signed)
    return pairs.where("estimate >= 0.75").select("a", "b", F.round("estimate", 6).alias("estimate"))


@query
def dedup_clusters(spark, sf):
    return O.duplicate_clusters(documents(spark, sf))


@query
def dedup_keep(spark, sf):
    return O.minhash_dedup(documents(spark, sf)).select("doc_id", "lang", "source")


@query
def dedup_keep_verified(spark, sf):
    return O.minhash_dedup(documents(spark, sf), verify=True).select("doc_id", "lang", "source")


@query
def dedup_keep_per_source(spark, sf):
    return O.minhash_dedup(documents(spark, sf), scope_col="source").select("doc_id", "lang", "source")


@query
def exact_dedup(spark, sf):
    return O.exact_dedup(documents(spark, sf))


# --- the whole job ----------------------------------------------------------------------------------------------


def _corpus(spark, sf):
    config = O.CorpusConfig(RECIPE, _quality(spark, sf), _toxic(spark, sf), _language(spark, sf), dict(enumerate(LANGS)))
    return O.clean_corpus(documents(spark, sf), config)


@query
def clean_corpus(spark, sf):
    return _corpus(spark, sf).select("doc_id", "status", "domains", "n_tokens")


@query
def corpus_funnel(spark, sf):
    return O.funnel(_corpus(spark, sf))


# --- streams ------------------------------------------------------------------------------------------------------


@query
def stream_filter_query(spark, sf):
    docs = table(spark, sf, "documents")
    dst = fresh_path(spark, "stream")
    run = stream_filter(
        spark, sf, dst, dst + "-checkpoint", docs.schema,
        lambda d: O.heur_filter(d, RECIPE).select("doc_id", "lang", "source"), glob="documents.parquet",
    )
    run.awaitTermination()
    return spark.read.parquet(dst)


@query
def stream_split_query(spark, sf):
    docs = table(spark, sf, "documents")
    dst = fresh_path(spark, "stream-scored")
    model = _toxic(spark, sf)
    run = stream_split(
        spark, sf, f"{dst}/kept", f"{dst}/rejects", f"{dst}/checkpoint", docs.schema,
        lambda d: O.toxic_predictions(d, model).select("doc_id", "source", "predictions"), F.col("predictions") == 0,
        glob="documents.parquet",
    )
    run.awaitTermination()
    both = [spark.read.parquet(f"{dst}/{t}").withColumn("sink", F.lit(t)) for t in ("kept", "rejects")]
    return both[0].unionByName(both[1]).select("doc_id", "source", "predictions", "sink")


@query
def stream_distinct_urls_query(spark, sf):
    rows = table(spark, sf, "pages")
    dst = fresh_path(spark, "stream-urls")
    run = stream_distinct_urls(
        spark, sf, dst, dst + "-checkpoint", rows.schema, "link", glob="pages.parquet",
        extract=lambda p: p.select("url", F.explode(X.hrefs("html")).alias("href")).select(X.url_join("url", "href").alias("link")),
    )
    run.awaitTermination()
    return spark.read.parquet(dst)


