"""One value to many rows, by Python table functions joined laterally.

A page or a file becomes rows beside the columns it came with; what cannot be expanded
becomes one row that says why, and never stops the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from textloom.functions.markup import page_nodes
from textloom.plans.checks import require_absent, require_columns
from textloom.sources.epub import epub_documents

NODE_FIELDS = "idx int, last int, parent int, tag string, classes array<string>, href string, rel array<string>, node_text string"


def _names(fields: str) -> list[str]:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(fields).names


def table_function(expand: Callable[[object], Iterable[tuple]], fields: str):
    """A table function of one argument: the rows of ``expand(value)`` with a null ``error``, or
    one row of nulls with the error's text.  A value's rows are made before any leaves, so it
    never has both."""
    width = len(_names(fields))

    class Expand:
        def eval(self, value):
            try:
                rows = [(*row, None) for row in expand(value)]
            except Exception as e:  # a bad value becomes a row
                rows = [(*[None] * width, f"{type(e).__name__}: {e}")]
            yield from rows

    return F.udtf(Expand, returnType=f"{fields}, error string", useArrow=True)


def expand_rows(
    df: DataFrame, column: str, expand: Callable[[object], Iterable[tuple]], fields: str, keep: list[str] | None = None
) -> DataFrame:
    """``df`` (or its columns ``keep``) joined laterally to the rows of ``expand(column)``; a value
    without rows disappears."""
    require_columns(df, column, *(keep or []))
    kept = df.columns if keep is None else keep
    require_absent(df.select(*kept), *_names(fields), "error")
    rows = table_function(expand, fields)(F.col(column).outer())
    return df.lateralJoin(rows).select(*kept, *_names(fields), "error")


def page_node_rows(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Every node of every page as a row, in document order (``idx``)."""
    return expand_rows(pages, html_col, _page, NODE_FIELDS, keep)


def _page(html: str | None) -> list[tuple]:
    if html is None:
        raise ValueError("no page")
    return page_nodes(html)


def epub_rows(files: DataFrame, content_col: str = "content", keep: list[str] | None = None) -> DataFrame:
    """The HTML items of every e-book file, given as bytes."""
    return expand_rows(files, content_col, lambda blob: enumerate(epub_documents(bytes(blob))), "item_idx int, html string", keep)
