"""A page as a flat list of nodes, so that page rules can be Spark expressions.

Only splitting markup into nodes needs Python; which node means what is decided by
the expressions in ``textloom.operators.pages``.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

from textloom.functions.text import strip_ws

NODES = (
    "array<struct<idx:int,last:int,parent:int,tag:string,classes:array<string>,"
    "href:string,rel:array<string>,text:string>>"
)

MARKUP_AT_ONCE = 1 << 20  # characters of markup whose nodes a worker holds at once

# Elements that never have content.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

_PIECE = re.compile(
    r"<!--.*?-->|<![^>]*>|<\?[^>]*>"
    r"|<(?P<raw>script|style)\b[^>]*>.*?</(?P=raw)\s*>"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


def page_nodes(page: str) -> list[tuple]:
    """``(idx, last, parent, tag, classes, href, rel, text)`` of a page's nodes in document order."""
    out: list[list] = []
    open_: list[int] = []

    def add(tag, classes=None, href=None, rel=None, text=None):
        out.append([len(out), len(out), open_[-1] if open_ else -1, tag, classes, href, rel, text])

    for m in _PIECE.finditer(page):
        if m["text"] is not None:
            add("#text", text=_html.unescape(m["text"]))
        elif m["tag"]:
            tag = m["tag"].lower()
            if m["end"]:
                if any(out[i][3] == tag for i in open_):
                    while True:
                        i = open_.pop()
                        out[i][1] = len(out) - 1
                        if out[i][3] == tag:
                            break
                continue
            attrs = {}
            for name, value in _ATTR.findall(m["attrs"]):
                attrs.setdefault(name.lower(), _html.unescape(value.strip("\"'")))
            add(tag, attrs.get("class", "").split(), attrs.get("href"), attrs.get("rel", "").split())
            if tag not in VOID and not m["attrs"].endswith("/"):
                open_.append(len(out) - 1)
    for i in open_:
        out[i][1] = len(out) - 1
    return [tuple(n) for n in out]


def _page_parts(pages: pd.Series, most: int = MARKUP_AT_ONCE) -> Iterator[pd.Series]:
    """Slices of about ``most`` characters of markup, at least one page each."""
    ends = pages.str.len().fillna(0).to_numpy(dtype="int64").cumsum()
    i = 0
    while i < len(pages):
        before = ends[i - 1] if i else 0
        j = max(int(ends.searchsorted(before + most, "right")), i + 1)
        yield pages.iloc[i:j]
        i = j


def _node_lists(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A page's nodes take many times its own room, so those of few pages are held at once."""
    names = ("idx", "last", "parent", "tag", "classes", "href", "rel", "text")
    for s in pages:
        for some in _page_parts(s):
            yield some.map(lambda p: [dict(zip(names, n)) for n in page_nodes(p)], na_action="ignore")


def html_nodes(c: Column | str) -> Column:
    """Nodes of each page in document order; ``last`` is a node's last descendant."""
    return F.pandas_udf(_node_lists, NODES)(c)


def inside(node: Column, box: Column) -> Column:
    return (node["idx"] > box["idx"]) & (node["idx"] <= box["last"])


def has_class(node: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(node["classes"], name), F.lit(False))


def select(nodes: Column, keep) -> Column:
    """Nodes for which ``keep(node)`` holds, in document order; empty without a page."""
    return F.filter(F.coalesce(nodes, F.array().cast(NODES)), lambda n: F.coalesce(keep(n), F.lit(False)))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def text_of(nodes: Column, box: Column) -> Column:
    """All text below ``box``, put together without a separator and trimmed."""
    inner = select(nodes, lambda n: (n["tag"] == "#text") & inside(n, box))
    return F.when(box.isNotNull(), strip_ws(F.array_join(F.transform(inner, lambda n: n["text"]), "")))
