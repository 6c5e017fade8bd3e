"""Up-front argument checks, made on the schema before any job starts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the frame has {df.columns}")


def require_absent(df: DataFrame, *names: str) -> None:
    taken = [n for n in names if n in df.columns]
    if taken:
        raise ValueError(f"column(s) {taken} would be overwritten; rename them first")


def require_unique(df: DataFrame, name: str) -> None:
    """One narrow count per key; raises if a key repeats or is null."""
    if not df.groupBy(name).count().where(f"count > 1 or `{name}` is null").isEmpty():
        raise ValueError(f"{name} must be unique and not null")
