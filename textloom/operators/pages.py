"""Crawled pages: book records, link extraction, pagination, the catalogue."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.markup import first, has_class, html_nodes, inside, select, text_of
from textloom.functions.text import hrefs, html_to_text, record_filename, remove_label, url_join, url_without_tail
from textloom.plans.barrier import computed
from textloom.plans.checks import require_columns
from textloom.plans.lineage import durable
from textloom.plans.skew import balanced_join


@dataclass(frozen=True)
class NextRule:
    """Where a listing page names its next page.  The defaults are the site's fixed values."""

    box: str = "wp-pagenavi"
    current: str = "current"
    next_link: str = "nextpostslink"
    page: str = "page"


@dataclass(frozen=True)
class BookTemplate:
    """Where a book page keeps its fields.  The defaults are the site's fixed values."""

    title_box: str = "col-xs-12 col-sm-8 col-md-8 col-lg-8"
    author_box: str = "mg-t-10"
    author_label: str = "Tác giả:"
    category_box: str = "mg-tb-10"
    category_label: str = "Thể loại:"
    link_class: str = "button"
    formats: tuple[str, ...] = ("pdf", "epub", "mobi")


@dataclass(frozen=True)
class LinkRule:
    """Which links lead to a book.  The defaults are the site's fixed values."""

    suffix: str = ".html"
    contains: str = "/sach-"
    never: tuple[str, ...] = ("/category/", "/page/")
    item_class: str = "item_sach"
    title_class: str = "title_sach"
    menu_class: str = "menu-item"
    category: str = "/category/"

    def is_book(self, href: Column) -> Column:
        return F.coalesce(href.endswith(self.suffix) | href.contains(self.contains), F.lit(False))

    def is_plain_book(self, href: Column) -> Column:
        """The last tier's test, which also rules out category and page links."""
        keep = self.is_book(href)
        for part in self.never:
            keep = keep & ~href.contains(part)
        return keep


def link_filter(df: DataFrame, href_col: str, rule: LinkRule = LinkRule()) -> DataFrame:
    """Rows whose link names a book, by the strictest tier."""
    require_columns(df, href_col)
    return df.where(rule.is_plain_book(F.col(href_col)))


# --- records ---------------------------------------------------------------------------


def page_records(pages: DataFrame) -> DataFrame:
    """``(page_id, url, title, lang, links)`` of any page: first ``h1``, declared language,
    all link targets."""
    require_columns(pages, "page_id", "url", "html")
    title = F.regexp_extract("html", r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1)
    lang = F.regexp_extract("html", r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']([^\"']*)", 1)
    return pages.select(
        "page_id", "url",
        F.nullif(html_to_text(title), F.lit("")).alias("title"),
        F.nullif(lang, F.lit("")).alias("lang"),
        hrefs("html").alias("links"),
    )


def _is_format(formats: tuple[str, ...], i: int):
    """Test for links of ``formats[i]``: earlier formats take precedence."""

    def test(n: Column) -> Column:
        ok = has_class(n, formats[i])
        for earlier in formats[:i]:
            ok = ok & ~has_class(n, earlier)
        return ok

    return test


def _downloads(template: BookTemplate) -> tuple[Column, Column]:
    """Map format -> last link of that format, and whether such a link had no target."""
    buttons = select(F.col("nodes"), lambda n: (n["tag"] == "a") & has_class(n, template.link_class))
    entries, broken = [], F.lit(False)
    for i, fmt in enumerate(template.formats):
        links = F.filter(buttons, _is_format(template.formats, i))
        entries += [F.lit(fmt), F.get(links, F.size(links) - 1)["href"]]
        broken = broken | F.exists(links, lambda n: n["href"].isNull())
    return F.create_map(*entries), broken


def book_records(pages: DataFrame, template: BookTemplate = BookTemplate()) -> DataFrame:
    """One metadata record per page that follows the book template as far as it goes.

    Missing fields are null; a page that breaks the template's promises (a download
    button without a target) or has no HTML gives no record.
    """
    require_columns(pages, "url", "html")
    n = F.col("nodes")
    t = template
    boxes = select(n, lambda x: (x["tag"] == "div") & (F.array_join(x["classes"], " ") == t.title_box))
    title_box = first(boxes)
    heading = first(select(n, lambda x: (x["tag"] == "h1") & inside(x, title_box)))
    author_box = first(
        select(n, lambda x: (x["tag"] == "div") & has_class(x, t.author_box) & text_of(n, x).contains(t.author_label))
    )
    category_box = first(
        select(n, lambda x: (x["tag"] == "div") & has_class(x, t.category_box) & text_of(n, x).contains(t.category_label))
    )
    links = select(n, lambda x: (x["tag"] == "a") & inside(x, category_box))
    downloads, broken = _downloads(t)
    return (
        computed(pages.where("html is not null"), {"nodes": html_nodes("html")}, ["url"])
        .withColumn("__broken", broken)
        .where("not __broken")
        .select(
            "url",
            text_of(n, heading).alias("title"),
            remove_label(text_of(n, author_box), t.author_label).alias("author"),
            F.transform(links, lambda a: text_of(n, a)).alias("categories"),
            downloads.alias("downloads"),
        )
        .withColumn("filename", record_filename("title", t.formats[0]))
    )


def metadata_defaults(meta: DataFrame, title: str = "Unknown Title") -> DataFrame:
    """Records with a title and a download map; a missing link stays null."""
    require_columns(meta, "title", "downloads")
    empty = F.create_map().cast("map<string,string>")
    return meta.withColumns({
        "title": F.coalesce("title", F.lit(title)),
        "downloads": F.coalesce("downloads", empty),
    })


# --- links -----------------------------------------------------------------------------


def site_root(url: Column | str) -> Column:
    return F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1), F.lit("/"))


def link_tiers(pages: DataFrame, rule: LinkRule = LinkRule()) -> DataFrame:
    """``pages`` with ``links``: raw book links of the first tier that finds any.

    Tier 1 takes the first link of each item box, tier 2 title links and links in
    headings, tier 3 any link with a slash.  The boxes of tiers 1 and 2 are looked for
    in Python only on pages whose markup mentions them.
    """
    require_columns(pages, "html")
    marked = F.col("html").contains(rule.item_class) | F.col("html").contains(rule.title_class) | F.col("html").rlike("(?i)<h4")
    n = F.col("nodes")
    with_slash = lambda a: (a["tag"] == "a") & a["href"].contains("/")
    items = select(n, lambda x: (x["tag"] == "div") & has_class(x, rule.item_class))
    tier1 = F.filter(
        F.transform(items, lambda b: first(select(n, lambda a: (a["tag"] == "a") & a["href"].isNotNull() & inside(a, b)))["href"]),
        rule.is_book,
    )
    headings = select(n, lambda x: x["tag"] == "h4")
    titled = select(
        n,
        lambda a: ((a["tag"] == "a") & has_class(a, rule.title_class))
        | (with_slash(a) & F.exists(headings, lambda h: inside(a, h))),
    )
    # a title link without a target makes the whole page unreadable
    unreadable = (F.size("t1") == 0) & F.exists("titled", lambda a: a["href"].isNull())
    tier2 = F.filter(F.transform("titled", lambda a: a["href"]), rule.is_book)
    tier3 = F.filter(hrefs("html"), lambda h: h.contains("/") & rule.is_plain_book(h))
    none = F.array().cast("array<string>")
    return (
        computed(pages, {"nodes": html_nodes(F.when(marked, F.col("html")))})
        .withColumns({"t1": tier1, "titled": titled})
        .withColumn("t2", tier2)
        .withColumn(
            "links",
            F.when(unreadable | F.col("html").isNull(), none)
            .when(F.size("t1") > 0, F.col("t1")).when(F.size("t2") > 0, F.col("t2")).otherwise(tier3),
        )
        .drop("nodes", "t1", "titled", "t2")
    )


def page_links(pages: DataFrame, rule: LinkRule = LinkRule(), root: str | None = None) -> DataFrame:
    """``(url, link)``: distinct absolute book links per page, resolved against the site
    root (``root``, or that of the page itself)."""
    require_columns(pages, "url", "html")
    base = F.lit(root) if root else site_root("url")
    found = link_tiers(pages.select("url", "html"), rule).select("url", base.alias("base"), "links")
    absolute = F.array_distinct(F.transform("links", lambda h: url_join(F.col("base"), h)))
    return found.select("url", F.explode(absolute).alias("link"))


def pages_without_links(pages: DataFrame, rule: LinkRule = LinkRule()) -> DataFrame:
    """Pages on which no tier found a link, for inspection."""
    return link_tiers(pages, rule).where(F.size("links") == 0).select(*pages.columns)


def distinct_links(links: DataFrame, link_col: str = "link") -> DataFrame:
    return links.select(link_col).distinct()


def category_urls(pages: DataFrame, rule: LinkRule = LinkRule()) -> DataFrame:
    """``(category)``: distinct category links of the menu, as written on the page."""
    require_columns(pages, "html")
    n = F.col("nodes")
    entries = select(n, lambda x: (x["tag"] == "li") & has_class(x, rule.menu_class))
    links = select(
        n, lambda a: (a["tag"] == "a") & a["href"].contains(rule.category) & F.exists(entries, lambda li: inside(a, li))
    )
    return (
        computed(pages.where(F.col("html").contains(rule.menu_class)), {"nodes": html_nodes("html")}, [])
        .select(F.explode(F.transform(links, lambda a: a["href"])).alias("category"))
        .distinct()
    )


# --- pagination --------------------------------------------------------------------------


def next_edges(pages: DataFrame, rule: NextRule = NextRule()) -> DataFrame:
    """``(src, dst)``: a page and the page its pagination block names as the next one."""
    require_columns(pages, "url", "html")
    n = F.col("nodes")
    navi = first(select(n, lambda x: (x["tag"] == "div") & has_class(x, rule.box)))
    current = first(select(n, lambda x: (x["tag"] == "span") & has_class(x, rule.current) & inside(x, F.col("navi"))))
    sibling = first(
        select(
            n,
            lambda x: (x["parent"] == F.col("current")["parent"]) & (x["idx"] > F.col("current")["idx"]) & (x["tag"] != "#text"),
        )
    )
    follows = F.when((F.col("sibling")["tag"] == "a") & F.col("sibling")["href"].contains(rule.page), F.col("sibling")["href"])

    def anchor(test) -> Column:
        return first(
            select(n, lambda x: (x["tag"] == "a") & x["href"].isNotNull() & inside(x, F.col("navi")) & test(x))
        )["href"]

    href = F.coalesce(
        follows, anchor(lambda x: has_class(x, rule.next_link)), anchor(lambda x: F.array_contains(x["rel"], "next"))
    )
    return (
        computed(pages.where(F.col("html").contains(rule.box)), {"nodes": html_nodes("html")}, ["url"])
        .withColumn("navi", navi).where("navi is not null")
        .withColumn("current", current).withColumn("sibling", sibling)
        .select(F.col("url").alias("src"), F.nullif(href, F.lit("")).alias("href"))
        .where("href is not null")
        .select("src", url_join("src", "href").alias("dst"))
    )


def follow_chain(
    starts: DataFrame, edges: DataFrame, start_col: str = "start", paged: str | None = "/page/", max_doublings: int = 40
) -> DataFrame:
    """``(start, depth, url)``: the pages reached from each start by next links.

    A page has at most one next link.  Every round doubles the step of the jump table,
    so a chain of a million pages takes twenty joins.  A chain ends where there is no
    next link, at a page already visited, or, after the first step, at a link that
    lacks ``paged``.
    """
    require_columns(starts, start_col)
    require_columns(edges, "src", "dst")
    # should a page have been stored twice with different links, the smaller one counts
    one = durable(edges.where("dst is not null").groupBy("src").agg(F.min("dst").alias("dst")), "next")
    roots = starts.select(F.col(start_col).alias("start")).distinct()
    opening = roots.join(one, F.col("start") == F.col("src"))
    first_step = opening.where("dst <> start").select("start", F.lit(1).cast("long").alias("depth"), F.col("dst").alias("url"))
    seen = durable(
        roots.select("start", F.lit(0).cast("long").alias("depth"), F.col("start").alias("url")).unionByName(first_step),
        "chain",
    )
    jump = one.where(F.col("dst").contains(paged)) if paged else one
    step = 1
    for _ in range(max_doublings):
        reached = (
            balanced_join(seen.where("depth > 0"), jump.withColumnRenamed("src", "url"), ["url"])
            .select("start", (F.col("depth") + step).alias("depth"), F.col("dst").alias("url"))
        )
        fresh = durable(
            reached.groupBy("start", "url").agg(F.min("depth").alias("depth"))
            .join(seen.select("start", "url"), ["start", "url"], "left_anti")
            .select("start", "depth", "url"),
            "reached",
        )
        if fresh.isEmpty():
            return seen
        seen = seen.unionByName(fresh)  # a union of stored tables, one per doubling
        far = jump.select(F.col("src").alias("dst"), F.col("dst").alias("end"))
        jump = durable(balanced_join(jump, far, ["dst"]).select("src", F.col("end").alias("dst")), "jump")
        step *= 2
    raise RuntimeError("a chain is longer than the given number of doublings allows")


# --- the catalogue -------------------------------------------------------------------------


def url_requested(url: Column | str) -> Column:
    """A URL as it is requested: without its fragment."""
    return F.regexp_replace(url, "(?s)#.*$", "")


def frontier_join(frontier: DataFrame, pages: DataFrame, url_col: str = "url", ignore_query: bool = False) -> DataFrame:
    """Stored pages of a frontier of URLs; fragments are not requested and do not count,
    nor does the query with ``ignore_query``.  URLs that were never fetched give no row."""
    require_columns(frontier, url_col)
    require_columns(pages, "url", "html")
    key = url_without_tail if ignore_query else url_requested
    wanted = frontier.select(key(url_col).alias("__u")).distinct()
    return balanced_join(pages.withColumn("__u", key("url")), wanted, ["__u"]).drop("__u")


def category_books(pages: DataFrame, categories: DataFrame, rule: LinkRule = LinkRule(), root: str | None = None) -> DataFrame:
    """``(category, page, book)``: one row per book link on a page of a category;
    pages without a link keep a row with a null book."""
    require_columns(categories, "category")
    listed = follow_chain(categories.withColumnRenamed("category", "start"), next_edges(pages))
    links = page_links(pages, rule, root).select(F.col("url").alias("page"), F.col("link").alias("book"))
    return (
        listed.select(F.col("start").alias("category"), F.col("url").alias("page"))
        .join(links, "page", "left").select("category", "page", "book")
    )


def category_counts(books: DataFrame) -> DataFrame:
    """Per category: distinct pages and book links, repeated ones included."""
    require_columns(books, "category", "page", "book")
    return books.groupBy("category").agg(
        F.countDistinct("page").alias("n_pages"), F.count("book").alias("n_books")
    )


def crawl_catalog(
    pages: DataFrame, home: str, rule: LinkRule = LinkRule(), template: BookTemplate = BookTemplate()
) -> DataFrame:
    """Book records of the site whose home page is ``home``: categories, their pages,
    the books on these, and each book's own page."""
    categories = category_urls(pages.where(F.col("url") == home), rule)
    books = durable(category_books(pages, categories, rule, home), "category-books")
    unique = books.where("book is not null").select(F.col("book").alias("url")).distinct()
    return book_records(frontier_join(unique, pages), template)


def download_formats(meta: DataFrame, id_col: str = "url") -> DataFrame:
    """``(id_col, format, link, filename)``: one row per stored format."""
    require_columns(meta, id_col, "title", "downloads")
    present = F.map_filter("downloads", lambda _, v: v.isNotNull() & (v != ""))
    rows = meta.select(id_col, "title", F.explode(present).alias("format", "link"))
    return rows.select(id_col, "format", "link", record_filename("title", F.col("format")).alias("filename"))


def download_coverage(meta: DataFrame) -> DataFrame:
    """Books with at least one usable download, and all books."""
    require_columns(meta, "title", "downloads")
    usable = F.size(F.map_filter("downloads", lambda _, v: v.isNotNull() & (v != ""))) > 0
    named = F.col("title").isNotNull() & (F.col("title") != "")
    return meta.agg(
        F.count_if(F.coalesce(usable & named, F.lit(False))).alias("with_download"), F.count(F.lit(1)).alias("books")
    )
