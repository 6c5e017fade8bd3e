"""Computing expressions once.

The optimizer copies an expression into every place that uses it and into filters pushed
below it.  A generator of exactly one row stops that: what is inside is computed once per
row, while filters on the other columns still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``columns``, each evaluated once per row."""
    kept = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
