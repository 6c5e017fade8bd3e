import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from textloom import sources as S
from textloom.operators import epub_texts
from textloom.sources.epub import epub_item_texts

RECORD = {
    "url": "http://h/1", "title": "Truyện", "author": None, "categories": ["a", "b"],
    "downloads": {"pdf": None, "epub": "http://h/1.epub"}, "filename": "Truyện.pdf",
}


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([RECORD, RECORD], ensure_ascii=False, indent=2))
    rows = S.read_metadata_json(spark, str(tmp_path / "array.json")).collect()
    assert len(rows) == 2 and rows[0].downloads == RECORD["downloads"] and rows[0].categories == ["a", "b"]
    S.write_metadata(S.read_metadata_json(spark, str(tmp_path / "array.json")), str(tmp_path / "lines"))
    raw = "".join(p.read_text() for p in (tmp_path / "lines").glob("part*"))
    assert "Truyện" in raw and '"author":null' in raw
    assert S.read_metadata_json(spark, str(tmp_path / "lines")).collect() == rows


def test_malformed_json_stops(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"url": 1, ')
    with pytest.raises(Exception):
        S.read_metadata_json(spark, str(tmp_path / "bad.json")).collect()


def test_missing_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        S.read_table(spark, str(tmp_path / "none"))


def test_split_reads_one_folder(spark, tmp_path):
    spark.createDataFrame([("a", "train"), ("b", "data")], "text string, split string").write.partitionBy("split").parquet(str(tmp_path / "t"))
    df = S.read_split(spark, str(tmp_path / "t"), "data")
    assert [r.text for r in df.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(split" in df._jdf.queryExecution().executedPlan().toString()


def test_list_files_matches_case_sensitively(spark, tmp_path):
    for n in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / n).write_bytes(b"123")
    assert [(r.name, r.length) for r in S.list_files(spark, str(tmp_path), "*.pdf").collect()] == [("a.pdf", 3)]


def test_gzip_sentences_are_spread(spark, tmp_path):
    with gzip.open(tmp_path / "s.txt.gz", "wt") as f:
        f.write("một\nhai\n")
    assert S.read_sentences(spark, str(tmp_path / "s.txt.gz")).count() == 2
    df = S.read_sentences(spark, str(tmp_path / "s.txt.gz"), 3)
    assert sorted(r.text for r in df.collect()) == ["hai", "một"] and df.rdd.getNumPartitions() == 3


def test_publish_never_overwrites_its_input(spark, tmp_path):
    src = str(tmp_path / "d")
    spark.range(3).write.parquet(src)
    out = S.publish(spark.read.parquet(src).where("id > 0"), src)
    assert spark.read.parquet(out).count() == 2 and spark.read.parquet(src).count() == 3
    with pytest.raises(ValueError):
        S.publish(spark.read.parquet(src), src, "")


def test_split_off(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, bad boolean")
    good = S.split_off(df, F.col("bad"), str(tmp_path / "q"))
    assert sorted(r.i for r in good.collect()) == [2, 3]
    assert [r.i for r in spark.read.parquet(str(tmp_path / "q")).collect()] == [1]


def test_rename(spark):
    assert S.rename_text(spark.createDataFrame([("x",)], "Sentence string"), "Sentence").columns == ["text"]


def _epub(path, items):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("META-INF/container.xml", '<container xmlns="urn:c"><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
        listed = "".join(f'<item id="i{i}" href="c%20{i}.xhtml" media-type="application/xhtml+xml"/>' for i in range(len(items)))
        z.writestr("OPS/p.opf", f'<package xmlns="http://www.idpf.org/2007/opf"><manifest>{listed}<item id="s" href="s.css" media-type="text/css"/></manifest></package>')
        for i, body in enumerate(items):
            z.writestr(f"OPS/c {i}.xhtml", body)


def test_epub_items_and_texts(spark, tmp_path):
    _epub(tmp_path / "một hai+.epub", [
        "<?xml version='1.0'?><html><body><h1>T&eacute;</h1><script>x()</script><style>b{}</style></body></html>",
        "<html><body>  </body></html>",
        "<html><body><p>a</p>\n<p>b &#38; c</p></body></html>",
    ])
    (tmp_path / "corrupt.epub").write_bytes(b"not a zip")
    items = S.epub_items(spark, str(tmp_path))
    assert items.where("error is null").count() == 3
    texts = {r.name: (r.text, r.error) for r in epub_texts(epub_item_texts(items)).collect()}
    assert texts["một hai+.epub"] == ("Té\n\na b & c", None)
    assert texts["corrupt.epub"][0] is None and "BadZipFile" in texts["corrupt.epub"][1]


def test_books_of_one_title_are_all_kept(spark, tmp_path):
    books = spark.createDataFrame([("p1", "A b!", "x"), ("p2", "A b", "y"), ("p3", "C", "z")], "path string, title string, text string")
    rows = {r.path: (r.safe_title, r.n_same_name, r.text) for r in S.book_texts(books).collect()}
    assert rows == {"p1": ("A_b", 2, "x"), "p2": ("A_b", 2, "y"), "p3": ("C", 1, "z")}
    S.write_book_texts(books, str(tmp_path / "files"), as_files=True)
    S.write_book_texts(books, str(tmp_path / "table"))
    assert spark.read.text(str(tmp_path / "files")).count() == 3 == spark.read.parquet(str(tmp_path / "table")).count()
