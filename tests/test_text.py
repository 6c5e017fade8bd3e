import html
import os.path
import re
import unicodedata
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from textloom import functions as X


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v")).alias("x")).collect()]


SPACED = ["", " ", "a", " a b ", "a b", "a\tb\x1cc", "x y　z\n", "\n\na\n", "a\x85b", "a​b", None]


def test_words_break_where_split_does(spark):
    assert column(spark, SPACED, X.words) == [None if s is None else s.split() for s in SPACED]
    assert column(spark, SPACED, X.word_count) == [None if s is None else len(s.split()) for s in SPACED]


def test_strip(spark):
    assert column(spark, SPACED, X.strip_ws) == [None if s is None else s.strip() for s in SPACED]


def test_collapse_newlines(spark):
    texts = ["a\n\n\nb\nc", "\na\n", "a\r\nb", None]
    assert column(spark, texts, X.collapse_newlines) == ["a b c", " a ", "a\r b", None]


TITLES = [
    'a\\b/c*d?e:f"g<h>i|j ',
    unicodedata.normalize("NFC", "Truyện Kiều – Nguyễn Du"),
    unicodedata.normalize("NFD", "Truyện Kiều – Nguyễn Du"),
    "½² ab", "!!!", "ends   ", "  starts", "under_score-dash", "",
]


def test_sanitize_filename(spark):
    want = [re.sub(r'[\\/*?:"<>|]', "_", t).strip() for t in TITLES]
    assert column(spark, TITLES, X.sanitize_filename) == want


def test_safe_title(spark):
    want = ["".join(c for c in t if c.isalnum() or c in " _-").rstrip().replace(" ", "_") for t in TITLES]
    assert column(spark, TITLES, X.safe_title) == want


NAMES = ["a.pdf", "a.b.pdf", ".pdf", "..pdf", "a", "a.", "a..pdf", "...a.b", "a b.PDF", ".a.pdf", "d.x/file", None]


def test_replace_extension(spark):
    want = [None if n is None else os.path.splitext(n)[0] + ".epub" for n in NAMES]
    assert column(spark, NAMES, lambda c: X.replace_extension(c, ".epub")) == want


def test_record_filename(spark):
    assert column(spark, ["a/b ", "", None], lambda c: X.record_filename(c, "pdf")) == ["a_b.pdf", None, None]


def test_snippet(spark):
    assert column(spark, ["x" * 500, "x" * 501, None], X.snippet) == ["x" * 500, "x" * 500 + "...", None]


BASES = ["http://h.example/a/b/c.html?q=1#f", "https://h.example", "https://h.example/", "http://h.example/d/"]
REFS = [
    "", "x.html", "/x/y", "../x", "../../x", "../../../x", "./x", ".", "..", "./", "../", "?p=2", "#top",
    "//other.example/z", "https://o.example/a/../b", "mailto:me@x.example", "x/../y?q=../z", "a/./b/../c#frag",
    "/a/../b/./c", "/../x",
]


@pytest.mark.parametrize("base", BASES)
def test_url_join(spark, base):
    assert column(spark, REFS, lambda c: X.url_join(F.lit(base), c)) == [urljoin(base, r) for r in REFS]


def test_url_parts(spark):
    urls = ["https://h.example/category/law/", "http://h.example/x?y#z", "plain"]
    assert column(spark, urls, X.url_slug) == ["law", "h.example", None]
    assert column(spark, urls, X.url_without_tail) == ["https://h.example/category/law/", "http://h.example/x", "plain"]
    assert column(spark, urls, X.url_host) == ["h.example", "h.example", ""]


class _Text(HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.parts.append("")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.parts.append("")

    def handle_comment(self, data):
        self.parts.append("")

    def handle_data(self, data):
        if not self.hidden:
            self.parts[-1:] = [(self.parts or [""])[-1] + data]


def visible(page):
    p = _Text()
    p.feed(page)
    p.close()
    return " ".join(s for s in (x.strip() for x in p.parts) if s)


PAGES = [
    "<p>a<b>b</b> c</p>", "<p> a\n b </p><p></p>x", "a<!-- no <b> --> b", '<script>var t="</p>";</script>z',
    "<style>p{}</style> <i>q</i>", "5 < 6 &amp;lt; &copy; &quot;x&quot;", '<a title="a>b">t</a>', "", "<p>un<b>closed",
    "<p title=it's>a</p>", "x<script>var a = 1", "x<style>p{}", "&amp b &am &eacute; S&aacute;ch &#225;", "<p a='>'>q</p>",
    "<br/>t<BR>u", "<?xml version='1.0'?>v", "<!DOCTYPE html>w", "<scripted>x</scripted>",
]


def test_html_to_text(spark):
    assert column(spark, PAGES, X.html_to_text) == [visible(p) for p in PAGES]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_html_to_text_of_given_pages(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").repartition(8).select("html", X.html_to_text("html")).collect()
    assert [page[:200] for page, got in rows if got != visible(page)] == []


def test_all_entities(spark):
    texts = ["&eacute;&#233;&#xe9; &amp;amp;", "&amp;", "no", "&bogus; & x", None]
    want = [None if t is None else html.unescape(t) for t in texts]
    assert column(spark, texts, X.decode_all_entities) == want


def test_hrefs(spark):
    pages = ["<a href='/x'>1</a><A class=\"c\" HREF=\"/y?a=1&amp;b=2\">2</A><a>3</a><!-- <a href='/no'> --><link href='/no'>"]
    assert column(spark, pages, X.hrefs) == [["/x", "/y?a=1&b=2"]]


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        self.found += [v or "" for k, v in attrs if tag == "a" and k == "href"]


LINKED = [
    "<a href=/b/x.html>1</a>", '<a href="/o\'neil.html">2</a>', "<a href='/q\"r'>3</a>", "<a href='/a&#38;b&eacute'>4</a>",
    '<a title="href=/no" href="/yes">5</a>', "<a class=x href = /sp >6</a>", "<abbr href=/no>7</abbr>", "<p>none</p>",
    '<a href="">8</a><a\nhref="/n">9</a>', "<script>x='<a href=/no>'</script><a href=/y>",
]


def test_hrefs_against_the_parser(spark):
    want = []
    for page in LINKED:
        p = _Links()
        p.feed(page)
        want.append(p.found)
    assert column(spark, LINKED, X.hrefs) == want
