import html
import re

import numpy as np
import pytest

from tests.llm.conftest import SF
from textloom.llm.pages import FEATURES, blocks_of, classify, extract_pages, fit_tree, labelled_blocks, main_text
from textloom.llm.queries import op10_html_extraction

TREE = fit_tree(*labelled_blocks())
SIDE = [
    "<nav><a href=/>home</a> and more words</nav>", "<header><h1>the site's own name</h1><p>a motto of it</p></header>",
    "<footer>made by somebody in some year</footer>", "<aside><p>words at the side that nobody needs</p></aside>",
    "<div class='cookie-banner'>we keep cookies here and there</div>", "<form><label>mail</label><input><button>go</button></form>",
    "<div id=comments><p>what a long and thoughtful comment this is, it goes on</p><p>yes</p></div>", "<div class=ad>buy now</div>",
    "<section class='related-posts'><h3>more</h3><p>another text to read on this site</p></section>", "<script>var a='<p>no</p>'</script>",
    "<style>p{}</style>", "<div hidden>secret words</div>", "<!-- a comment <p>no</p> -->", "<div role=navigation><p>to the top</p></div>",
]


@pytest.mark.parametrize("side", SIDE)
def test_side_matter_is_left_out(side):
    body = "<article><h1>Title of it</h1><p>First &amp; foremost,\n  a paragraph.</p><p>Yes.</p></article>"
    want = "Title of it First & foremost, a paragraph. Yes."
    for page in (side + body, body + side, body.replace("<p>Yes", side + "<p>Yes")):
        if "<header>" in side and page.startswith("<article"):
            continue  # an article's own header holds its title
        assert main_text(f"<html><body>{page}</body></html>", TREE) == want, page


@pytest.mark.parametrize("box", [
    "article class='has-sidebar post'", "div class='content sidebar-left'", "div class='post category-advertising tag-social'",
    "main class='page nav-open'", "section id=entry",
])
def test_layout_names_do_not_hide_the_article(box):
    page = f"<nav><a>home</a></nav><{box}><div class=entry-header><h1>Title of it</h1></div><p>{'some words of the text ' * 6}</p><p>Yes it is.</p></{box.split()[0]}><footer>end</footer>"
    assert main_text(page, TREE) == f"Title of it {('some words of the text ' * 6).strip()} Yes it is."


def test_pages_without_an_article():
    text = "a long paragraph of the story that has enough words to be told from all the rest of it " * 2
    page = f"<div><a>one</a><a>two</a></div><h1>the story</h1><p>{text}</p><p>{text}</p><p>{text}</p><p><a>next</a> <a>last</a></p>"
    assert main_text(page, TREE) == " ".join(["the story", *[text.strip()] * 3])


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op10_html_extraction(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        h = pages[r.page_id].html
        inner = h[h.index("<article>"):h.index("</article>")]
        assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_pages(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [
        (1, None), (2, ""), (3, "no tags at all"), (4, "<article><p>open <b>end"), (5, long), (5, long), (None, "<article>x</article>"),
        (6, "<article><p title=it's>quote</p></article>"), (7, "<article>a<script>never closed"), (8, "< <> <article>1 < 2 &lt; 3</article>"),
        (9, "<article>&#x41;&nbsp;&bogus;</article><a"),
    ]
    df = spark.createDataFrame([(i, "u", h, "x", 1) for i, h in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r.page_id or 0, r.text) for r in extract_pages(df).collect())
    many = " ".join(["some words here"] * 20_000)
    assert [g for g in got if g[0] != 3] == sorted([
        (0, "x"), (1, ""), (2, ""), (4, "open end"), (5, many), (5, many), (6, "quote"), (7, "a"), (8, "1 < 2 < 3"), (9, "A &bogus;"),
    ])
    assert extract_pages(df.limit(0)).count() == 0


def test_tree():
    x = np.array([[0.0], [1], [2], [3], [4], [5]])
    tree = fit_tree(x, np.array([0, 0, 0, 1, 1, 1], bool), leaf=1)
    assert tree == (0, 2.5, 0.0, 1.0) and classify(tree, x).tolist() == [False] * 3 + [True] * 3
    rows, labels = labelled_blocks()
    assert (classify(TREE, rows) == labels).mean() > 0.98 and len(rows) > 500
    assert [b.text for b in blocks_of("<p>a<br>b<p>c")] == ["a b", "c"]


LONG_TEXT = "words of the story that is told here go on for a while and do not end before the line is full again "
LEADS = [
    "<ul><li><a>home</a></li><li><a>about us</a></li></ul>", "<div><a>home</a> <a>about</a> <a>more of it</a></div>",
    "<table><tr><td><a>one</a></td><td><a>two</a></td></tr></table>", "<p><a>back to the start</a></p>", "",
    "<div><a>one</a></div><div><a>two</a></div><div><a>three</a></div>",
]
TAILS = [
    "<ul><li><a>older</a></li><li><a>newer</a></li></ul>", "<div><a>the next story on this site</a></div>", "",
    "<div><a>one</a> <a>two</a></div><div>made in a year</div>", "<p><a>up</a></p><p><a>down</a></p>", "<div>all rights reserved by them</div>",
]
BODIES = [
    (["<h1>{t}</h1>", "<p>{a}</p>", "<p>{b}</p>", "<p>{c}</p>"]), (["<h2>{t}</h2>", "<div>{a}</div>", "<div>{b}</div>"]),
    (["<h1>{t}</h1>", "<p>{a}</p>", "<p>yes it was so</p>", "<p>{b}</p>", "<p>{c}</p>"]),
    (["<h1>{t}</h1>", "<p>{a} <a>a link</a> in it</p>", "<p>{b}</p>"]), (["<h1>{t}</h1>", "<blockquote>{a}</blockquote>", "<p>{b}</p>", "<h2>{t}</h2>", "<p>{c}</p>"]),
    (["<div><div><h1>{t}</h1>", "<p>{a}</p></div>", "<p>{b}</p></div>"]),
]


@pytest.mark.parametrize("k", range(36))
def test_pages_without_telling_elements_or_names(k):
    a, b, c = (LONG_TEXT * n for n in (1 + k % 2, 2, 1 + k % 3))
    body = "".join(BODIES[k % 6]).format(t="The story", a=a, b=b, c=c)
    page = LEADS[k // 6] + body + TAILS[(k + k // 6) % 6]
    want = " ".join(re.sub(r"<[^>]*>", " ", body).split())
    assert main_text(f"<html><head><title>x</title></head><body>{page}</body></html>", TREE) == want


@pytest.mark.parametrize("page, want", [
    ("<div class='page-with-sidebar'><nav><a>home</a></nav><article><h1>It</h1><p>{x}</p></article></div>", "It {x}"),
    ("<div class='page-with-sidebar'><ul><li><a>home</a></ul><h1>It</h1><p>{x}</p><p>{x}</p></div>", "It {x} {x}"),
    ("<form id=aspnetForm><div><a>home</a></div><h1>It</h1><p>{x}</p><p>{x}</p></form>", "It {x} {x}"),
    ("<p>{x}{x}</p>", "{x}{x}"),
    ("<article><h1>It</h1><p>{x}</p></article><section><h3>What readers say</h3><p>{x}</p><p>fine</p></section>", "It {x}"),
    ("<article><h1>It</h1><p>{x}</p></article><div>Subscribe now for more stories</div>", "It {x}"),
    ("<main><h1>It</h1><p>{x}</p><p>short</p></main><div><p>{x}{x}{x}</p></div>", "It {x} short"),
    ("<article><h1>It</h1><p>brief</p></article><div id=comments><h2>Say</h2><p>{x}{x}{x}</p></div>", "It brief"),
])
def test_wrappers_and_what_stands_beside_the_article(page, want):
    got = main_text(page.replace("{x}", LONG_TEXT), TREE)
    assert got == " ".join(want.replace("{x}", LONG_TEXT).split())


def test_the_tree_asks_for_words_and_links():
    asked = set()

    def walk(tree):
        if isinstance(tree, tuple):
            asked.add(FEATURES[tree[0]])
            walk(tree[2])
            walk(tree[3])

    walk(TREE)
    assert FEATURES[TREE[0]] == "links" and {"words", "words_before", "words_after", "links_after"} <= asked
