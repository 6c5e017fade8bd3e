"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks at block-level tags.  A block is described by its words and
link density, by those of the blocks before and after it, and by what it stands in.  A
small table of labelled pages trains a decision tree (CART, Gini impurity) that tells main
text from boilerplate; the blocks it takes for main text are joined in page order.  Most of
the labelled pages have neither an article element nor telling names, so the tree has to
go by words and links.  An element that holds the page's title or its article and most of
the words outside links is a wrapper: its name or tag says nothing against what it holds.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from textloom.llm.batches import field, map_batches, narrow

DEPTH, LEAF = 8, 8   # of the tree

# Fixed values of HTML: which elements hold no text of the page, and which end a block.
SILENT = frozenset("script style template noscript iframe object svg math canvas audio video head title select textarea button".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HOLDERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 html body option legend summary dt dd tr td th tbody thead tfoot".split())

# What names of elements, classes, ids and roles say about their text.
SIDE_TAGS = frozenset("nav aside footer form dialog menu".split())
MAIN_TAGS = frozenset("article main".split())
SIDE_WORDS = frozenset(
    "ad ads adv side header form logo topbar toolbar overlay modal feedback respond reply replies discussion search skip "
    "contentinfo complementary dialog alert disclaimer".split()
)
SIDE_STARTS = tuple(
    "advert adsby adsense banner sponsor promo cookie consent gdpr notice notif popup newsletter subscri signup login "
    "share sharing social related recommend breadcrumb menu submenu nav sidebar widget footer masthead comment disqus "
    "pagin pager copyright teaser".split()
)
MAIN_WORDS = frozenset("article content post entry story main page body text".split())
STATES = ("category-", "tag-", "has-", "no-", "not-", "with-", "without-", "is-")  # say nothing about the element's role

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*))>|<!--(?:(?:-?>)|.*?(?:--!?>|\Z))|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z].*\Z""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.S | re.I)
_WORD = re.compile(r"[a-z]+")

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "in_side", "side_name",
    "main_name", "heading", "item", "main_elsewhere",
)


@dataclass(frozen=True)
class Block:
    text: str
    words: int
    linked: int      # words inside links
    in_main: bool
    in_side: bool
    side_name: bool
    main_name: bool
    heading: bool
    item: bool


def _side(word: str) -> bool:
    return word in SIDE_WORDS or word.startswith(SIDE_STARTS)


def _names(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element's names speak for boilerplate, and for main text.

    A name made of main words alone outweighs the others (``content sidebar-left``); a
    header that is named after an article (``entry-header``) holds its title.
    """
    if not attributes or tag in ("body", "html"):
        return False, False
    hidden, side, main = False, False, False
    for name, a, b, c in _NAMED.findall(attributes):
        name, value = name.lower(), (a or b or c)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name in ("class", "id", "role"):
            for part in value.split():
                if part.lower().startswith(STATES):
                    continue
                words = set(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", part).lower()))
                found = {w for w in words if _side(w)}
                if found == {"header"} and words & MAIN_WORDS:
                    found = set()
                side |= bool(found)
                main |= bool(words) and words <= MAIN_WORDS
    if tag in MAIN_TAGS:  # layout classes say nothing against an article, unless it is a comment or teaser
        side = side and bool(re.search(r"comment|reply|replies|teaser|related|\bads?\b", attributes, re.I))
    return hidden or (side and not main), main


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page, without empty ones."""
    out: list[Block] = []
    placed: list[tuple[tuple[int, ...], tuple[int, ...]]] = []  # the side elements around each block, by tag and by name
    outside: list[int] = []    # of each side element: words outside links,
    title: list[bool] = []     # and whether it holds the page's title or article
    stack: list[tuple] = []
    state = (False, (), (), False, False)  # in_main, side elements by tag, by name, main_name, item
    pieces: list[tuple[str, bool]] = []
    heading, links, at, n = "", 0, 0, len(page)

    def side_element() -> tuple[int]:
        outside.append(0)
        title.append(False)
        return (len(outside) - 1,)

    def close() -> None:
        if pieces:
            linked = 0
            for t, inside in pieces:
                if inside:
                    linked += len(t.split())
            text = " ".join("".join(t for t, _ in pieces).split())
            if text:
                in_main, tags, names, named, item = state
                words = len(text.split())
                for k in tags + names:
                    outside[k] += words - linked
                    title[k] |= heading == "h1"
                out.append(Block(text, words, linked, in_main, False, False, named, heading != "", item))
                placed.append((tags, names))
            pieces.clear()

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            pieces.append((html.unescape(page[at:]), links > 0))
            break
        if m.start() > at:
            pieces.append((html.unescape(page[at:m.start()]), links > 0))
        at = m.end()
        name = m[2]
        if name is None:
            continue
        tag, closing = name.lower(), bool(m[1])
        if tag in SILENT:
            if not closing and not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                if end is not None:
                    at = end.end()
                elif tag in ("script", "style"):
                    at = n
            continue
        if tag == "a":
            links = 0 if closing else 1
        elif tag == "br":
            pieces.append((" ", False))
        if tag not in BLOCKS:
            continue
        close()
        links = 0
        heading = tag if not closing and tag in ("h1", "h2", "h3", "h4", "h5", "h6") else ""
        if tag not in HOLDERS:
            if not closing and tag == "p" and m[3]:
                side, named = _names(tag, m[3])
                if side:  # a paragraph that is named so stands for itself until the next block
                    pieces_state = state
                    state = (state[0], state[1], state[2] + side_element(), state[3] or named, state[4])
                    stack.append(("p", *pieces_state))
            elif stack and stack[-1][0] == "p":
                state = stack.pop()[1:]
            continue
        if stack and stack[-1][0] == "p":
            state = stack.pop()[1:]
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    state = stack[k][1:]
                    del stack[k:]
                    break
            continue
        stack.append((tag, *state))
        side, named = _names(tag, m[3])
        in_main, tags, names, by_main, _ = state
        if tag in MAIN_TAGS and not side:
            for k in tags + names:
                title[k] = True
        by_tag = tag in SIDE_TAGS or tag == "header" and not in_main
        state = (
            in_main or tag in MAIN_TAGS, tags + side_element() if by_tag else tags, names + side_element() if side else names,
            by_main or named, tag == "li",
        )
    close()
    most = sum(b.words - b.linked for b in out) / 2
    speaks = [not (has and words > most) for words, has in zip(outside, title)]  # wrappers say nothing
    return [
        replace(b, in_side=any(speaks[k] for k in tags), side_name=any(speaks[k] for k in names))
        for b, (tags, names) in zip(out, placed)
    ]


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block of a page; what does not exist before or after counts as empty."""
    words = np.array([0, *(b.words for b in blocks), 0], float)
    links = np.array([0, *(b.linked for b in blocks), 0], float) / np.maximum(words, 1)
    links = np.round(links, 2)
    main = any(b.in_main and not (b.in_side or b.side_name) for b in blocks)
    own = np.array([
        [b.in_main, b.in_side, b.side_name, b.main_name, b.heading, b.item, main and not b.in_main] for b in blocks
    ], float)
    return np.column_stack([words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], own.reshape(-1, 7)])


# The labelled table: small pages, each filled in several ways.  S, L and A stand for a few
# words, many words and any number of words; * marks main text.
LABELLED = (
    "<p>*L</p>",
    "<div>*L</div>",
    "<div>*L</div><div><a>S</a> <a>S</a></div>",
    "<h1>*S</h1><div>*L</div><div>*L</div>",
    "<div><a>S</a> <a>S</a></div><p>*L</p><p>*S</p><p>*L</p><p>*L</p><div><a>S</a></div><div>S</div>",
    "<ul><li><a>S</a><li><a>S</a><li><a>S</a></ul><h1>*S</h1><p>*L</p><p>*L <a>S</a></p><h2>*S</h2><p>*L</p><ul><li><a>S</a><li><a>S</a></ul><p>S</p>",
    "<table><tr><td><a>S</a></td></tr><tr><td>*L</td></tr><tr><td>*L</td></tr><tr><td><a>S</a> <a>S</a></td></tr></table>",
    "<div><a>L</a></div><h1>*S</h1><p>*L</p><p>*S</p><p>*L</p><div><a>L</a></div><div><a>S</a> S</div>",
    "<h1>*S</h1><p>*L</p><ul><li>*S<li>*S<li>*L</ul><p>*L</p><ul><li><a>S</a><li><a>S</a></ul>",
    "<div>S</div><div><a>S</a></div><h2>*S</h2><div>*L</div><div>*S</div><div>*L</div><div><a>S</a></div><div>S</div><div><a>S</a></div>",
    "<p><a>S</a></p><p><a>S</a></p><p>*L</p><p>*L <a>S</a> L</p><p>*L</p><p><a>S</a></p><p><a>S</a></p>",
    "<div><a>S</a></div><div>S</div><div><a>S</a></div><p>*L</p><p>*L</p><div>S</div><div><a>S</a></div><div>S</div>",
    "<article><h1>*S</h1><p>*A</p><p>*A</p></article><section><h3>S</h3><p>A</p><p>L</p></section><div>A</div>",
    "<div>A</div><main><h1>*S</h1><p>*A</p><p>*A</p></main><div><p>L</p><p>A</p></div><p>S</p>",
    "<article><h1>*S</h1><p>*S</p><p>*S</p></article><nav><a>S</a></nav>",
    "<main><p>*S</p></main><div>S</div>",
    "<article><h1>*S</h1><p>*S</p></article><footer>S</footer>",
    "<article>*A</article><div><a>S</a></div>",
    "<article><h2>*S</h2><p>*S</p><p>*<a>S</a></p><p>*S</p></article><div>S</div>",
    "<nav><a>S</a><a>S</a></nav><div class=ad>A</div><article><h1>*S</h1><p>*A<p>*A<p>*A<p>*A<p>*A</article><footer>A</footer>",
    "<header><p>S</p><ul><li><a>S</a><li><a>S</a></ul></header><main><article><header><h2>*S</h2></header><p>*A</p><div class=share>S</div>"
    "<ul><li>*S<li>*A</ul><p>*A<section class=comments><h3>S</h3><p>A</p><p>L</p></section></article></main><aside><h3>S</h3><p>A</p></aside>",
    "<article><h1>*S</h1><p>*A</p><p>*A</p><p>*A <a>S</a></p><p>*<a>S</a></p><p>*S</p></article>",
    "<article><p>*A</p><aside>A</aside><p>*A</p><div class=advert><a>S</a></div><p>*A</p><form><p>A</p></form><p>*A</p></article><nav><a>S</a></nav>",
    "<div id=menu><a>S</a> <a>S</a></div><div id=content><h1>*S</h1><p>*A</p><p>*A</p><p>*A</p></div><div class='cookie-notice'><p>A</p></div>",
    "<div class='site-header'><h1>S</h1></div><div class='post entry'><h2>*S</h2><div>*L</div><blockquote>*A</blockquote><p>*A</p><form><p>A</p></form>"
    "</div><div class=sidebar><p>A</p><p>A</p></div><div class=comment><p>A</p></div><div id=footer><p>A</p></div>",
    "<article><p class=notice>A</p><h1>*S</h1><p>*A</p><aside>A</aside><p>*A</p><footer>A</footer></article><div class=related><h3>S</h3><a>S</a></div>",
    "<table><tr><td><a>S</a><td><a>S</a></table><h1>*S</h1><p>*L<p>*L<p>*L<p>*L<hr><p><a>S</a> <a>S</a>",
    "<ul><li><a>S</a><li><a>S</a></ul><div><h2>*S</h2><p>*L</p><p>*L</p><p>*L</p></div><ul><li><a>S</a><li><a>S</a></ul><p>S</p>",
    "<section class=newsletter><p>A</p></section><section><h2>*S</h2><p>*L</p><p>*L</p></section><ul><li><a>S</a></ul>",
    "<div>S</div><div><h1>*S</h1><p>*L</p><p>*L</p><p>*L</p></div><div>S</div>",
    "<h1>*S</h1><p>*L</p><p>*L</p><p>*L</p><div>S</div>",
    "<div class=popup>A</div><main><h1>*S</h1><p>*A</p><p>*A</p></main><div class=banner>A</div><div class=comments><p>A</p><p>A</p></div>",
)
FILLINGS = 24
_LENGTHS = {"S": (1, 9), "L": (14, 60), "A": (1, 60)}


def labelled_blocks(pages: tuple[str, ...] = LABELLED, fillings: int = FILLINGS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled table."""
    rng = np.random.default_rng(10)
    rows, labels = [], []
    for page in pages:
        for _ in range(fillings):
            filled = re.sub("[SLA](?=<|$| <| L|$)", lambda m: "word " * int(rng.integers(*_LENGTHS[m[0]])), page)
            found = blocks_of(filled)
            rows.append(features(found))
            labels += [b.text.startswith("*") for b in found]
    return np.concatenate(rows), np.array(labels)


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = DEPTH, leaf: int = LEAF):
    """``(feature, border, below, above)`` or a leaf's share of main text."""
    share = float(y.mean())
    best = None
    if depth and 0 < share < 1:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for border in (values[:-1] + values[1:]) / 2:
                low = x[:, f] <= border
                sizes = low.sum(), (~low).sum()
                if min(sizes) < leaf:
                    continue
                p, q = y[low].mean(), y[~low].mean()
                impurity = sizes[0] * p * (1 - p) + sizes[1] * q * (1 - q)
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(border))
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
        return share
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], fit_tree(x[low], y[low], depth - 1, leaf), fit_tree(x[~low], y[~low], depth - 1, leaf)


def classify(tree, x: np.ndarray) -> np.ndarray:
    """Which rows the tree takes for main text."""
    if not isinstance(tree, tuple):
        return np.full(len(x), tree > 0.5)
    f, border, below, above = tree
    low = x[:, f] <= border
    out = np.zeros(len(x), bool)
    out[low], out[~low] = classify(below, x[low]), classify(above, x[~low])
    return out


def main_text(page: str, tree) -> str:
    found = blocks_of(page)
    if not found:
        return ""
    return " ".join(b.text for b, keep in zip(found, classify(tree, features(found))) if keep)


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    labelled: tuple[np.ndarray, np.ndarray] | None = None,
) -> DataFrame:
    """``(id_col, url_col, text, n_chars)`` for every row of ``pages``.

    ``labelled`` holds features of blocks and whether they are main text; by default those
    of the table above.  White space inside a block becomes one space, blocks are joined by
    one space, character references are decoded.  A null page and one without main text
    give an empty text.  Unclosed elements end with the page.  Repeated rows and null ids
    each give a row of their own; other columns are ignored, whatever their names.
    """
    tree = fit_tree(*(labelled or labelled_blocks()))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(2)
        texts = []
        for page in column:
            value = page.as_py()
            texts.append(main_text(value, tree) if value else "")
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            [id_col, url_col, "text", "n_chars"],
        )

    return map_batches(narrow(pages, id=id_col, url=url_col, html=html_col), run, [
        field(pages, id_col), field(pages, url_col), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])
