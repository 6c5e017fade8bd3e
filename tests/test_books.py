from textloom.operators import (
    book_status, books_missing_file, books_with_file, epub_texts, select_epub_only, status_summary,
)

META = [
    ("has_pdf", {"pdf": "p", "epub": "e"}, "a.pdf"),
    ("empty_pdf", {"pdf": "", "epub": "e"}, "a.pdf"),
    ("null_epub", {"pdf": None, "epub": None}, "a.pdf"),
    ("empty_epub", {"epub": ""}, "a.pdf"),
    ("no_downloads", None, "a.pdf"),
    ("no_name", {"epub": "e"}, None),
    ("empty_name", {"epub": "e"}, ""),
    ("missing", {"epub": "e"}, "gone.pdf"),
    ("good", {"epub": "e"}, "a.b.pdf"),
    ("dots", {"epub": "e"}, "..pdf"),
    ("bad", {"epub": "e"}, "bad.pdf"),
    ("blank", {"epub": "e"}, "blank.pdf"),
]
FILES = [("a.b.epub", "text", None), ("..pdf.epub", "t", None), ("bad.epub", None, "BadZipFile"), ("blank.epub", "", None), ("extra.epub", "x", None)]
WANT = {
    "has_pdf": "criteria", "empty_pdf": "criteria", "null_epub": "criteria", "empty_epub": "criteria",
    "no_downloads": "criteria", "no_name": "filename_missing", "empty_name": "filename_missing",
    "missing": "file_missing", "good": "processed", "dots": "processed", "bad": "error", "blank": "processed",
}


def frames(spark):
    meta = spark.createDataFrame(META, "url string, downloads map<string,string>, filename string")
    return meta, spark.createDataFrame(FILES, "name string, text string, error string")


def test_one_status_per_book(spark):
    rows = book_status(*frames(spark)).collect()
    assert {r.url: r.status for r in rows} == WANT and len(rows) == len(META)
    assert {r.url for r in rows if r.text is not None} == {"good", "dots", "blank"}


def test_summary(spark):
    got = {r.status: r.n for r in status_summary(book_status(*frames(spark))).collect()}
    assert got == {"criteria": 5, "filename_missing": 2, "file_missing": 1, "processed": 3, "error": 1}


def test_selection_and_matching(spark):
    meta, files = frames(spark)
    assert {r.url for r in select_epub_only(meta).collect()} == {u for u, s in WANT.items() if s != "criteria"}
    assert {r.url for r in books_with_file(meta, files).collect()} == {"good", "dots", "bad", "blank"}
    assert {r.url for r in books_missing_file(meta, files).collect()} == {"missing"}


def test_files_of_one_name_give_one_status(spark):
    meta, files = frames(spark)
    twice = files.unionByName(spark.createDataFrame([("bad.epub", "readable", None), ("a.b.epub", None, "bad copy")], files.schema))
    rows = {r.url: (r.status, r.text) for r in book_status(meta, twice).collect()}
    assert len(rows) == len(META) and rows["bad"] == ("processed", "readable") and rows["good"] == ("processed", "text")


def test_status_with_a_map_first(spark):
    meta, files = frames(spark)
    assert book_status(meta.select("downloads", "url", "filename"), files).count() == len(META)


def test_percent_signs_in_file_names(spark):
    items = spark.createDataFrame([("file:/x/100%.epub", 0, "a", None), ("file:/x/y%41.epub", 0, "b", None)], "path string, item_idx int, text string, error string")
    assert sorted((r.name, r.text) for r in epub_texts(items).collect()) == [("100%.epub", "a"), ("y%41.epub", "b")]
