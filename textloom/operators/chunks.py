"""Cutting texts into a fixed number of word chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.text import words
from textloom.plans.checks import require_columns


def _drifting_starts(n: Column, n_chunks: int) -> Column:
    """Chunk starts found by adding a double step until the text is used up.

    Rounding lets the sum fall just short of the end for about half of all lengths,
    which yields one chunk more; that is part of the result to match.
    """
    step = n.cast("double") / F.lit(float(n_chunks))
    sums = F.aggregate(
        F.sequence(F.lit(1), F.lit(n_chunks + 1)),
        F.array(F.lit(0.0)),
        lambda acc, _: F.concat(acc, F.array(F.element_at(acc, -1) + step)),
    )
    return F.filter(sums, lambda s: s < n)


def chunk_words(
    df: DataFrame,
    n_chunks: int = 100,
    mode: str = "drift",
    keep_empty: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id_col, chunk_idx, text)``: about ``n_chunks`` runs of words per document.

    ``mode="drift"`` adds up a floating-point step; ``mode="exact"`` cuts at
    ``i * n / n_chunks`` in integers.  Texts without words give no chunk.
    """
    require_columns(df, id_col, text_col)
    if mode not in ("drift", "exact"):
        raise ValueError("mode must be 'drift' or 'exact'")
    cut = df.select(id_col, words(text_col).alias("w"))
    n = F.size("w")
    if mode == "drift":
        step = n.cast("double") / F.lit(float(n_chunks))
        spans = F.transform(
            _drifting_starts(n, n_chunks),
            lambda s: F.struct(
                F.floor(s).cast("int").alias("lo"), F.floor(s + step).cast("int").alias("hi")
            ),
        )
    else:
        big = n.cast("long")
        at = lambda i: F.floor(i * big / n_chunks).cast("int")
        every = F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long")),
            lambda i: F.struct(at(i).alias("lo"), at(i + 1).alias("hi")),
        )
        spans = F.when(n > 0, every)
    # chunks are built before the explode, so no output row carries the whole text
    pieces = F.transform("spans", lambda s: F.array_join(F.slice("w", s["lo"] + 1, s["hi"] - s["lo"]), " "))
    out = (
        cut.withColumn("spans", spans)
        .select(id_col, F.posexplode(pieces).alias("chunk_idx", "text"))
    )
    return out if keep_empty else out.where("text <> ''")
