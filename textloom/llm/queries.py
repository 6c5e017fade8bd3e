"""The registered queries of this package: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textloom.llm.alignment import align
from textloom.llm.decontaminate import find_leaks
from textloom.llm.language import fit_language_model, identify_language
from textloom.llm.lines import repeated_lines
from textloom.llm.mixing import document_rates, fit_domain_model, fit_mix
from textloom.llm.near_text import near_duplicates
from textloom.llm.near_vectors import near_vectors
from textloom.llm.oracles import ORACLES
from textloom.llm.pages import extract_pages
from textloom.llm.prefix_trie import ends_digest, prefix_trie
from textloom.llm.repeats import repeated_spans
from textloom.llm.shards import assign_shards
from textloom.llm.token_counts import count_tokens
from textloom.llm.token_files import read_boundaries, write_token_files
from textloom.plans import fresh_path
from textloom.sources import read_table

VOCABULARY = "word_bpe_49k.json"  # a file of the installed public tokenizers
MAX_TOKENS = 2048
BYTE_VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
PIECES = "piece_bpe_32k.model"
# Domains are the pairs of labels; their shares of the tokens after mixing.
WEIGHTS = {"q1t0": 0.78, "q0t0": 0.12, "q1t1": 0.07, "q0t1": 0.03}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a file of the public tokenizers lies; only queries that need one import them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place, under the law of equal bytes."""
    placed = assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, exactly or with a few edits."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text."""
    return count_tokens(
        table(spark, sf_dir, "documents"), vocabulary(tokenizer_file(VOCABULARY)), limit=MAX_TOKENS
    )


def domain() -> Column:
    """The domain of a row of ``labels``."""
    return F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("t"), F.col("toxic").cast("string"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's rate under the target weights of the domains."""
    docs = table(spark, sf_dir, "documents")
    model = fit_domain_model(docs, table(spark, sf_dir, "labels"), domain())
    return document_rates(docs, fit_mix(docs, model, WEIGHTS))


def held_out() -> Column:
    """The fold that no language model learns from: a quarter of the documents, by id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~held_out()))
    found = identify_language(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents and the one that stays."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-duplicate embeddings of one label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op8_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stretches of text that repeat what stands elsewhere first."""
    return repeated_spans(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that are like a line that stands elsewhere first."""
    return repeated_lines(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every whole page."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shared beginning of the rebuilt conversations."""
    trie = prefix_trie(table(spark, sf_dir, "conversations"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return trie.nodes.join(ends_digest(trie), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the files of token ids, read back from the files."""
    path = write_token_files(
        table(spark, sf_dir, "documents"), fresh_path(spark, "token-files"),
        vocabulary(tokenizer_file(BYTE_VOCABULARY)), END_ID,
    )
    return read_boundaries(spark, path)


def piece_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' ids meet on every whole text, and how common their links are."""
    rows = align(
        table(spark, sf_dir, "documents"), vocabulary(tokenizer_file(BYTE_VOCABULARY)),
        piece_model(tokenizer_file(PIECES)),
    )
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return rows.withColumn("groups_sha256", digest).drop("groups")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_decontamination, op3_token_counts, op4_mixing, op5_language, op6_minhash_dedup,
        op7_embedding_dedup, op8_repeated_spans, op9_line_dedup, op10_html_extraction,
        op11_prefix_trie, op12_token_files, op13_alignment,
    )
}

__all__ = ["ORACLES", "QUERIES"]
