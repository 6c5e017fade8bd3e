from textloom.operators.books import (
    book_status,
    books_missing_file,
    books_with_file,
    epub_texts,
    select_epub_only,
    status_summary,
)
from textloom.operators.chunks import chunk_words
from textloom.operators.components import components
from textloom.operators.corpus import CorpusConfig, clean_corpus, funnel
from textloom.operators.dedup import (
    bands,
    candidates,
    duplicate_clusters,
    exact_dedup,
    jaccard,
    minhash_dedup,
    shingles,
    signatures,
    slot_similarity,
)
from textloom.operators.evaluation import auc, held_out
from textloom.operators.heuristics import Recipe, heur_filter, heur_stats
from textloom.operators.pages import (
    BookTemplate,
    LinkRule,
    book_records,
    category_books,
    category_counts,
    category_urls,
    crawl_catalog,
    download_coverage,
    download_formats,
    follow_chain,
    frontier_join,
    link_filter,
    metadata_defaults,
    next_edges,
    page_links,
    page_records,
    pages_without_links,
)
from textloom.operators.scorers import (
    NaiveBayes,
    batch_model,
    fit_linear,
    fit_nb,
    quality_filter,
    tag_domain,
    tensor_model,
    tensor_scores,
    toxic_filter,
    toxic_predictions,
    toxic_rejects,
)
from textloom.operators.statistics import (
    concat_items,
    corpus_summary,
    domain_distribution,
    drop_empty_text,
    filter_funnel,
    token_stats,
)
from textloom.operators.tokens import (
    build_vocabulary,
    count_tokens,
    encode,
    pack,
    pack_dropped,
    token_offsets,
    truncate_pad,
)
