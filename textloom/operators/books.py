"""Books that exist only as e-books: selection, matching to files, outcome of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.text import replace_extension
from textloom.plans.checks import require_columns
from textloom.plans.skew import balanced_join, hashable

STATUSES = ("criteria", "filename_missing", "file_missing", "error", "processed")


def _epub_only() -> Column:
    return F.col("downloads")["pdf"].isNull() & (F.coalesce(F.col("downloads")["epub"], F.lit("")) != "")


def select_epub_only(meta: DataFrame) -> DataFrame:
    """Books without a PDF link (an empty link counts as one) and with an e-book link."""
    require_columns(meta, "downloads")
    return meta.where(_epub_only())


def with_epub_name(meta: DataFrame, name_col: str = "epub_name") -> DataFrame:
    """Name under which the e-book should lie, derived from the record's file name."""
    require_columns(meta, "filename")
    return meta.withColumn(name_col, replace_extension(F.nullif(F.col("filename"), F.lit("")), ".epub"))


def books_with_file(meta: DataFrame, files: DataFrame) -> DataFrame:
    """E-book-only records whose file is listed."""
    require_columns(files, "name")
    wanted = with_epub_name(select_epub_only(meta)).where("epub_name is not null")
    return wanted.join(files.select(F.col("name").alias("epub_name")), "epub_name", "left_semi").select(*meta.columns, "epub_name")


def books_missing_file(meta: DataFrame, files: DataFrame) -> DataFrame:
    """E-book-only records with a file name that is not listed."""
    require_columns(files, "name")
    wanted = with_epub_name(select_epub_only(meta)).where("epub_name is not null")
    return wanted.join(files.select(F.col("name").alias("epub_name")), "epub_name", "left_anti").select(*meta.columns, "epub_name")


def book_status(meta: DataFrame, texts: DataFrame) -> DataFrame:
    """``meta`` with ``text`` and ``status``, the first test that failed or ``processed``.

    ``texts`` has one row ``(name, text, error)`` per listed file.  An empty text counts
    as processed, a null one as an error.  One status per record, however many files
    share its name.
    """
    require_columns(meta, "downloads", "filename")
    require_columns(texts, "name", "text", "error")
    # files of one name are one file: a readable one if there is any
    found = texts.groupBy(F.col("name").alias("epub_name")).agg(
        F.min(F.struct((F.col("error").isNotNull() | F.col("text").isNull()).alias("bad"), "text", "error")).alias("file")
    ).select("epub_name", "file.text", "file.error", F.lit(True).alias("__there"))
    # a record without a name gets a key of its own: null keys would all meet in one task
    own = F.concat(F.lit("\0"), F.xxhash64(*hashable(meta)).cast("string"))
    keyed = with_epub_name(meta, "__name").withColumn("epub_name", F.coalesce("__name", own))
    joined = balanced_join(keyed, found, ["epub_name"], "left")
    status = (
        F.when(~_epub_only(), "criteria")
        .when(F.col("__name").isNull(), "filename_missing")
        .when(F.col("__there").isNull(), "file_missing")
        .when(F.col("error").isNotNull() | F.col("text").isNull(), "error")
        .otherwise("processed")
    )
    marked = joined.withColumn("status", status)
    return marked.select(*meta.columns, F.when(F.col("status") == "processed", F.col("text")).alias("text"), "status")


def status_summary(df: DataFrame) -> DataFrame:
    require_columns(df, "status")
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def epub_texts(items: DataFrame) -> DataFrame:
    """``(name, text, error)`` per e-book file from its items: texts in item order,
    empty ones skipped, a blank line between them."""
    require_columns(items, "path", "item_idx", "text", "error")
    parts = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("item_idx", "text"))))
    files = items.groupBy("path").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "\n\n").alias("text"), F.max("error").alias("error")
    )
    name = F.element_at(F.split("path", "/"), -1)  # paths are not encoded
    return files.select(name.alias("name"), F.when(F.col("error").isNull(), F.col("text")).alias("text"), "error")
