"""From raw documents to shards: every stage reads the stored result of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm.decontaminate import find_leaks, without_leaks
from textloom.llm.language import fit_language_model, with_language
from textloom.llm.mixing import fit_domain_model, fit_mix, mixed
from textloom.llm.near_text import near_duplicates, without_near_duplicates
from textloom.llm.queries import WEIGHTS, domain, held_out, table
from textloom.llm.shards import shard_documents
from textloom.plans import durable


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: texts with letters whose n-grams are about as frequent
    as in the labelled texts of a language.  Null, empty and letterless texts go; repeated rows
    share their fate; rows without an id are judged like all others."""
    return with_language(docs, fit_language_model(docs.where(~held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id.  Rows without an id and
    rows with an empty text are like no other and stay; of rows that share an id one stays."""
    return without_near_duplicates(docs, near_duplicates(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, exactly or with few edits.  A row goes by its id and text,
    whether it has an id or not; null and empty texts hold nothing and stay."""
    leaks = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return without_leaks(docs, durable(leaks.select("doc_id", "text_hash").distinct(), "leaks"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask: every row at least once, those of scarce
    domains more often.  Null and empty texts have no tokens and stay once."""
    model = fit_domain_model(docs, table(spark, sf_dir, "labels"), domain())
    return mixed(docs, fit_mix(docs, model, WEIGHTS, least=1.0))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place in it, null and empty texts and rows without an id too."""
    return shard_documents(docs)


STAGES = [
    ("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard),
]

ORACLE_SQL = None  # trained models and seeded hashing are not SQL; the tests hold a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
