import pandas as pd
from pyspark.sql import functions as F

from textloom.functions import markup
from textloom.operators import (
    LinkRule, book_records, category_books, category_counts, category_urls, crawl_catalog, download_coverage,
    download_formats, follow_chain, frontier_join, link_filter, metadata_defaults, next_edges, page_links,
    pages_without_links,
)

HOME = "https://books.example/"


def pages(spark, rows):
    return spark.createDataFrame(list(rows.items()), "url string, html string")


def book(title="<h1> Sách A/B </h1>", links="", author="<div class='mg-t-10 x'>Tác giả: <b>Nguyễn</b> Du </div>"):
    return f"""<html><div class="col-xs-12 col-sm-8 col-md-8 col-lg-8"><div>{title}</div></div>
    <div class="mg-t-10">Năm: 2000</div>{author}
    <div class="mg-tb-10">Thể loại: <a href="/category/a/"> Thơ </a>, <a>Cổ</a></div>{links}</html>"""


def records(spark, **rows):
    return {r.url: r for r in book_records(pages(spark, rows)).collect()}


def test_full_template(spark):
    links = '<a class="button pdf" href="/1.pdf">p</a><a class="button epub" href="/1.epub">e</a>'
    r = records(spark, u=book(links=links))["u"]
    assert (r.title, r.author, r.categories) == ("Sách A/B", "Nguyễn Du", ["Thơ", "Cổ"])
    assert r.downloads == {"pdf": "/1.pdf", "epub": "/1.epub", "mobi": None}
    assert r.filename == "Sách A_B.pdf"


def test_missing_parts_are_null(spark):
    got = records(spark, no_h1=book(title="x"), nothing="<p>hi", broken="<div class='mg-t-10'>Tác giả: X<p>", empty=book(title="<h1> </h1>"))
    assert got["no_h1"].title is None and got["no_h1"].filename is None
    assert got["nothing"].author is None and got["nothing"].categories == [] and set(got["nothing"].downloads.values()) == {None}
    assert got["broken"].author == "X"
    assert got["empty"].title == "" and got["empty"].filename is None


def test_title_needs_the_exact_class_string(spark):
    page = '<div class="col-sm-8 col-xs-12 col-md-8 col-lg-8"><h1>no</h1></div><h1>no</h1>'
    assert records(spark, u=page)["u"].title is None


def test_last_link_wins_and_pdf_outranks_epub(spark):
    links = (
        '<a class="button pdf" href="/old.pdf"></a><a class="pdf" href="/not-a-button"></a>'
        '<a class="button epub pdf" href="/both"></a><a class="button mobi" href="/m"></a>'
    )
    assert records(spark, u=book(links=links))["u"].downloads == {"pdf": "/both", "epub": None, "mobi": "/m"}


def test_button_without_target_drops_the_record(spark):
    got = records(spark, bad=book(links='<a class="button pdf">x</a>'), ok=book())
    assert set(got) == {"ok"}


TIERS = {
    HOME + "one": '<div class="item_sach"><p><a name="x">-</a><a href="/b1.html">1</a><a href="/b2.html">2</a></p></div>'
    '<div class="box item_sach"><a href="/other">no</a></div><a class="title_sach" href="/b9.html">t</a>',
    HOME + "two": '<div class="item_sach"><a href="/other">no</a></div><a class="title_sach" href="b3.html">t</a>'
    '<h4><i><a href="/sach-hay">h</a></i></h4><h4><a href="b4.html">no slash</a></h4><a class="title_sach" href="b3.html">t</a>',
    HOME + "three": '<a href="/x/b5.html">5</a><a href="/category/b6.html">c</a><a href="/page/2.html">p</a><a href="b7.html">no slash</a>',
    HOME + "bad": '<a class="title_sach">no target</a><a href="/x/b8.html">8</a>',
    HOME + "none": "<p>nothing</p>",
}


def test_link_tiers(spark):
    got = {}
    for r in page_links(pages(spark, TIERS), root=HOME).collect():
        got.setdefault(r.url, set()).add(r.link)
    assert got == {
        HOME + "one": {HOME + "b1.html"},
        HOME + "two": {HOME + "b3.html", HOME + "sach-hay"},
        HOME + "three": {HOME + "x/b5.html"},
    }


def test_pages_without_links(spark):
    assert {r.url for r in pages_without_links(pages(spark, TIERS)).collect()} == {HOME + "bad", HOME + "none"}


def test_link_filter(spark):
    df = spark.createDataFrame([("/a.html",), ("/sach-1",), ("/category/a.html",), ("/x",), (None,)], "href string")
    assert [r.href for r in link_filter(df, "href").collect()] == ["/a.html", "/sach-1"]


def navi(inner):
    return f"<a href='/page/99'>out</a><div class='wp-pagenavi'>{inner}</div>"


C = HOME + "category/law/"
PAGED = {
    C: navi("<span class='current'>1</span>\n<a href='page/2/'>2</a><a class='nextpostslink' href='/wrong'>n</a>"),
    C + "page/2/": navi("<span class='current'>2</span><span>gap</span><a class='nextpostslink' href='../3/'>n</a>"),
    C + "page/3/": navi("<a rel='nofollow next' href='../4/'>n</a>"),
    C + "page/4/": navi("<span class='current'>4</span><a href='/category/law/page/2/'>loop to a page</a>"),
    HOME + "single": "<p>no block</p>",
    HOME + "first": navi("<a class='nextpostslink' href='/elsewhere'>n</a>"),
    HOME + "elsewhere": navi("<a class='nextpostslink' href='/elsewhere2'>n</a>"),
    HOME + "elsewhere2": "x",
    HOME + "last": navi("<span class='current'>9</span>"),
}


def test_next_edges(spark):
    assert {(r.src, r.dst) for r in next_edges(pages(spark, PAGED)).collect()} == {
        (C, C + "page/2/"), (C + "page/2/", C + "page/3/"), (C + "page/3/", C + "page/4/"),
        (C + "page/4/", C + "page/2/"), (HOME + "first", HOME + "elsewhere"), (HOME + "elsewhere", HOME + "elsewhere2"),
    }


def test_chain_stops_at_loops_and_foreign_pages(spark):
    starts = spark.createDataFrame([(C,), (HOME + "single",), (HOME + "first",), (HOME + "gone",)], "start string")
    got = {}
    for r in follow_chain(starts, next_edges(pages(spark, PAGED))).collect():
        got.setdefault(r.start, {})[r.depth] = r.url
    assert got == {
        C: {0: C, 1: C + "page/2/", 2: C + "page/3/", 3: C + "page/4/"},
        HOME + "single": {0: HOME + "single"},
        HOME + "first": {0: HOME + "first", 1: HOME + "elsewhere"},  # the next one is no page of the list
        HOME + "gone": {0: HOME + "gone"},
    }


def test_long_chain_and_ring(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(100)] + [(f"r{i}", f"r{(i + 1) % 7}") for i in range(7)] + [("self", "self")], "src string, dst string")
    starts = spark.createDataFrame([("n0",), ("n90",), ("r3",), ("self",)], "start string")
    rows = follow_chain(starts, edges, paged=None).collect()
    assert sorted(r.depth for r in rows if r.start == "n0") == list(range(101))
    assert sorted(r.depth for r in rows if r.start == "n90") == list(range(11))
    assert sorted((r.depth, r.url) for r in rows if r.start == "r3") == [(i, f"r{(3 + i) % 7}") for i in range(7)]
    assert [(r.depth, r.url) for r in rows if r.start == "self"] == [(0, "self")]


def site():
    rows = {
        HOME: "<ul><li class='menu-item x'><a href='%s'>law</a><a href='/about'>no</a></li></ul><a href='/category/no/'>no</a>" % C,
        C: navi("<span class='current'>1</span><a href='page/2/'>2</a>") + "<div class='item_sach'><a href='/b1.html'>1</a></div>",
        C + "page/2/": "<div class='item_sach'><a href='/b1.html'>1</a></div><div class='item_sach'><a href='/b2.html'>2</a></div>",
        HOME + "b1.html": book(title="<h1>One</h1>"),
        HOME + "b2.html": book(title="<h1>Two</h1>"),
        HOME + "b3.html": book(title="<h1>Unlisted</h1>"),
    }
    return rows


def test_catalog(spark):
    p = pages(spark, site())
    categories = category_urls(p)
    assert [r.category for r in categories.collect()] == [C]
    books = category_books(p, categories, root=HOME)
    assert [tuple(r) for r in category_counts(books).collect()] == [(C, 2, 3)]
    assert sorted(r.title for r in crawl_catalog(p, HOME).collect()) == ["One", "Two"]


def test_frontier_join(spark):
    """A URL is requested as it is, but for its fragment."""
    frontier = spark.createDataFrame([("/a?id=1",), ("/b#y",), ("/c/missing",)], "url string")
    stored = pages(spark, {"/a?id=1": "1", "/a?id=2": "2", "/b#top": "b", "/c": "c"})
    assert {r.url for r in frontier_join(frontier, stored).collect()} == {"/a?id=1", "/b#top"}
    assert {r.url for r in frontier_join(frontier, stored, ignore_query=True).collect()} == {"/a?id=1", "/a?id=2", "/b#top"}


def test_metadata_defaults_and_downloads(spark):
    meta = spark.createDataFrame(
        [("1", None, None), ("2", "T", {"pdf": "p", "epub": None}), ("3", "U", {"pdf": ""}), ("4", "", {"pdf": "p"})],
        "url string, title string, downloads map<string,string>",
    )
    rows = {r.url: r for r in metadata_defaults(meta).collect()}
    assert rows["1"].title == "Unknown Title" and rows["1"].downloads == {}
    assert [tuple(r) for r in download_formats(meta).where(F.col("url") == "2").collect()] == [("2", "pdf", "p", "T.pdf")]
    assert tuple(download_coverage(meta).first()) == (1, 4)


def test_custom_rule(spark):
    rule = LinkRule(suffix=".xml", contains="/item-")
    got = page_links(pages(spark, {HOME: "<a href='/a.xml'>a</a><a href='/a.html'>b</a>"}), rule).collect()
    assert [r.link for r in got] == [HOME + "a.xml"]


def test_nodes_of_few_pages_are_held_at_once():
    """A large batch leaves in slices, with every page once and in order."""
    page = "<li class='menu-item'><a href='/category/x'>c</a></li>" * 2000  # 100 KB
    batch = pd.Series([page, None, "", "<p>a"] * 30)
    parts = list(markup._node_lists(iter([batch, batch[:0], batch[3:4]])))
    assert max(len(p) for p in parts) <= 44 and len(parts) >= 4
    whole = pd.concat(parts)
    assert [None if x is None else len(x) for x in whole[:4]] == [6000, None, 0, 2] and len(whole) == 121
