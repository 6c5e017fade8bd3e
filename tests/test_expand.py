import pytest
from pyspark.sql import functions as F

from textloom.sources import epub_items, epub_rows, expand_rows, page_node_rows
from tests.test_sources import _epub


def test_values_become_rows_or_an_error(spark):
    def numbers(text):
        if text is None:
            return []
        return [(k, int(p)) for k, p in enumerate(text.split())]

    df = spark.createDataFrame([(1, "3 4"), (2, ""), (3, "5 x"), (4, None), (5, "9")], "id int, text string").repartition(2)
    got = sorted((r.id, r.k is None, r.k or 0, r.n, r.error) for r in expand_rows(df, "text", numbers, "k int, n long", ["id"]).collect())
    assert [g[:4] for g in got] == [(1, False, 0, 3), (1, False, 1, 4), (3, True, 0, None), (5, False, 0, 9)]
    assert [bool(g[4]) for g in got] == [False, False, True, False] and got[2][4].startswith("ValueError: ")
    assert expand_rows(df.limit(0), "text", numbers, "k int, n long").count() == 0
    with pytest.raises(ValueError, match="overwritten"):
        expand_rows(df.withColumn("k", F.lit(1)), "text", numbers, "k int, n long")


def test_page_nodes(spark):
    df = spark.createDataFrame([(1, '<div class="a b"><a href="/x?1&amp;2" rel=next>t</a></div>'), (2, None), (3, "")], "page_id int, html string")
    rows = page_node_rows(df, keep=["page_id"]).orderBy("page_id", "idx").collect()
    assert [(r.page_id, r.tag, r.href, r.node_text, r.parent) for r in rows if not r.error] == [
        (1, "div", None, None, -1), (1, "a", "/x?1&2", None, 0), (1, "#text", None, "t", 1),
    ]
    assert rows[0].classes == ["a", "b"] and rows[1].rel == ["next"]
    assert [(r.page_id, r.error, r.tag) for r in rows if r.error] == [(2, "ValueError: no page", None)]


def test_books_by_the_table_function_are_those_of_the_reader(spark, tmp_path):
    _epub(tmp_path / "a.epub", ["<p>one</p>", "<p>two</p>"])
    _epub(tmp_path / "b.epub", ["<p>three</p>"])
    (tmp_path / "c.epub").write_bytes(b"not a zip")
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    got = epub_rows(files, keep=["path"]).select("path", "item_idx", "html", "error")
    want = epub_items(spark, str(tmp_path))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() == 4
