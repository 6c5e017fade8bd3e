"""Counts and summaries over document tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from textloom.plans.checks import require_columns


def token_stats(df: DataFrame, count_col: str = "n_tokens") -> DataFrame:
    """Rows, total, mean, maximum and interpolated 95th percentile in one pass.

    The percentile is exact: it keeps one counter per distinct length, and lengths
    are small integers.  An empty table gives 0 rows and null for the others.
    """
    require_columns(df, count_col)
    n = F.col(count_col)
    return df.agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum(n).alias("total_tokens"),
        F.avg(n).alias("mean_tokens"),
        F.max(n).alias("max_tokens"),
        F.percentile(n, 0.95).alias("p95_tokens"),
    )


def filter_funnel(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter, without running it twice."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(F.coalesce(keep, F.lit(False))).alias("rows_kept")
    )


def corpus_summary(
    df: DataFrame, levels: Sequence[str], text_col: str = "text", count_col: str = "n_tokens"
) -> DataFrame:
    """Samples, tokens and bytes for each level of ``levels`` and in total.

    A level that a row sums over holds ``Total``.
    """
    require_columns(df, *levels, text_col, count_col)
    slim = df.select(*levels, F.col(count_col).alias("t"), F.octet_length(text_col).cast("long").alias("b"))
    sums = slim.rollup(*levels).agg(
        *[F.grouping(c).alias(f"__{c}") for c in levels],
        F.count(F.lit(1)).alias("samples"),
        F.sum("t").alias("tokens"),
        F.sum("b").alias("bytes"),
    )
    names = [F.when(F.col(f"__{c}") == 1, "Total").otherwise(F.col(c)).alias(c) for c in levels]
    return sums.select(*names, "samples", "tokens", "bytes")


def domain_distribution(df: DataFrame, domain_col: str = "domains") -> DataFrame:
    """Documents and share per domain; the total is a scalar subquery over the counts."""
    require_columns(df, domain_col)
    counts = df.groupBy(domain_col).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(domain_col, "n", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("share"))


def concat_items(
    df: DataFrame, key: str, idx: str, text_col: str = "text", sep: str = "\n\n", drop_empty: bool = True
) -> DataFrame:
    """One text per ``key``: its items in order of ``idx``, joined by ``sep``.

    The group is one output cell (a book's text), so it fits a row by definition.
    A key whose items are all dropped keeps an empty text.
    """
    require_columns(df, key, idx, text_col)
    t = F.col(text_col)
    wanted = t.isNotNull() & (t != "") if drop_empty else t.isNotNull()
    parts = F.array_sort(F.collect_list(F.when(wanted, F.struct(F.col(idx).alias("i"), t.alias("t")))))
    return df.groupBy(key).agg(F.array_join(F.transform(parts, lambda p: p["t"]), sep).alias(text_col))


def drop_empty_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    require_columns(df, text_col)
    return df.where(F.col(text_col).isNotNull() & (F.col(text_col) != ""))
