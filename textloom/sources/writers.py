"""Where results go.  Nothing here overwrites a path that may still be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.text import safe_title
from textloom.plans.checks import require_columns
from textloom.plans.skew import key_weights, lookup_join


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).parquet(path)
    return path


def publish(df: DataFrame, path: str, suffix: str = "_clean") -> str:
    """Write the result beside its input; the input itself is never overwritten."""
    if not suffix:
        raise ValueError("an empty suffix would overwrite the input")
    return write_table(df, path.rstrip("/") + suffix, "overwrite")


def write_metadata(df: DataFrame, path: str) -> str:
    """JSON lines in UTF-8; null fields are kept, non-ASCII text is not escaped."""
    df.write.option("ignoreNullFields", False).json(path)
    return path


def split_off(df: DataFrame, bad: Column, path: str) -> DataFrame:
    """Send the rows for which ``bad`` holds to a table at ``path``; return the others."""
    flag = F.coalesce(bad, F.lit(False))
    df.where(flag).write.parquet(path)
    return df.where(~flag)


def book_texts(
    books: DataFrame, id_col: str = "path", title_col: str = "title", text_col: str = "text",
    default_title: str = "Unknown Title",
) -> DataFrame:
    """``(safe_title, n_same_name, id_col, text_col)``: book texts under their safe title.

    A book without a title gets the default one.  Books that would share a file name are
    all kept; ``n_same_name`` tells how many there are.
    """
    require_columns(books, id_col, title_col, text_col)
    title = F.coalesce(F.col(title_col), F.lit(default_title))
    named = books.select(safe_title(title).alias("safe_title"), id_col, text_col)
    counts = key_weights(named, ["safe_title"], "n_same_name").withColumn("__w", F.col("n_same_name"))
    return lookup_join(named, counts, ["safe_title"], "__w").select("safe_title", "n_same_name", id_col, text_col)


def write_book_texts(books: DataFrame, path: str, as_files: bool = False, **cols: str) -> str:
    """Parquet keyed by title, or (``as_files``) one text folder per title and book."""
    out = book_texts(books, **cols)
    if not as_files:
        return write_table(out, path)
    text_col, id_col = cols.get("text_col", "text"), cols.get("id_col", "path")
    out.select("safe_title", id_col, text_col).write.partitionBy("safe_title", id_col).text(path)
    return path
