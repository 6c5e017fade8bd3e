import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from textloom.functions import hrefs, url_join
from textloom.operators import Recipe, heur_filter, heur_stats
from textloom.streaming import ingest, stream_distinct_urls, stream_filter, stream_split

RECIPE = Recipe(bounds=[("word_count", 30, None), ("repeated_line_ratio", None, 0.2)])


def test_stream_equals_batch_and_resumes(spark, docs, tmp_path):
    src, dst, mark = (str(tmp_path / n) for n in ("src", "dst", "mark"))
    docs.where("doc_id < 120").repartition(3).write.parquet(src)

    def run():
        stream_filter(spark, src, dst, mark, docs.schema, lambda d: heur_filter(d, RECIPE), files_per_trigger=1).awaitTermination()
        return spark.read.parquet(dst)

    first = heur_filter(docs.where("doc_id < 120"), RECIPE)
    assert run().exceptAll(first).isEmpty() and run().count() == first.count()
    docs.where("doc_id >= 120").write.mode("append").parquet(src)
    whole = heur_filter(docs, RECIPE)
    out = run()
    assert out.exceptAll(whole).isEmpty() and whole.exceptAll(out).isEmpty()


def test_each_url_once_across_batches(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    src, dst, mark = (str(tmp_path / n) for n in ("src", "dst", "mark"))
    pages.repartition(4).write.parquet(src)
    links = lambda p: p.select("url", F.explode(hrefs("html")).alias("h")).select(url_join("url", "h").alias("url"))
    stream_distinct_urls(spark, src, dst, mark, pages.schema, extract=links, files_per_trigger=1).awaitTermination()
    got = spark.read.parquet(dst)
    want = links(pages).distinct()
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_watermarked_state_drops_repeats(spark, tmp_path):
    src, dst, mark = (str(tmp_path / n) for n in ("src", "dst", "mark"))
    rows = spark.sql("select * from values ('a', timestamp'2024-01-01'), ('a', timestamp'2024-01-02'), ('b', timestamp'2024-01-02') t(url, seen)")
    rows.write.parquet(src)
    stream_distinct_urls(spark, src, dst, mark, rows.schema, arrival_col="seen").awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(dst).collect()) == ["a", "b"]


def test_split_equals_batch_after_a_broken_and_replayed_batch(spark, docs, tmp_path, monkeypatch):
    """The run breaks between the two sinks of its second batch; the replay leaves every row once."""
    src, kept, rejects, mark = (str(tmp_path / n) for n in ("src", "kept", "rejects", "mark"))
    docs.where("doc_id < 120").repartition(3).write.parquet(src)
    calls, seen = [], []
    score = lambda d: (calls.append(1), heur_stats(d, ["word_count"]).withColumn("word_count", F.when(F.col("doc_id") % 9 != 0, F.col("word_count"))))[1]
    keep = F.col("word_count") >= 200
    write = ingest._write_part

    def failing(df, dst, batch_id):
        seen.append((batch_id, dst))
        if len(seen) == 4:
            raise RuntimeError("lost driver")
        write(df, dst, batch_id)

    def run():
        stream_split(spark, src, kept, rejects, mark, docs.schema, score, keep, files_per_trigger=1).awaitTermination()

    monkeypatch.setattr(ingest, "_write_part", failing)
    with pytest.raises(StreamingQueryException):
        run()
    assert seen == [(0, kept), (0, rejects), (1, kept), (1, rejects)] and len(calls) == 2
    run()
    docs.where("doc_id >= 120").write.mode("append").parquet(src)
    run()
    whole = heur_stats(docs, ["word_count"]).withColumn("word_count", F.when(F.col("doc_id") % 9 != 0, F.col("word_count")))
    for dst, want in ((kept, whole.where(keep)), (rejects, whole.where(~F.coalesce(keep, F.lit(False))))):
        got = spark.read.parquet(dst).drop("batch_id")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and want.count() > 5
    assert len(calls) >= 4  # one scoring for each batch and for the replay


def test_split_scores_each_batch_once(spark, docs, tmp_path):
    """Both sinks are written from one stored frame."""
    src = str(tmp_path / "src")
    docs.repartition(1).write.parquet(src)
    hits = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def count(x):
        hits.add(1)
        return int(x) % 2

    stream_split(
        spark, src, str(tmp_path / "a"), str(tmp_path / "b"), str(tmp_path / "m"), docs.schema,
        lambda d: d.withColumn("odd", count("doc_id")), F.col("odd") == 1,
    ).awaitTermination()
    assert hits.value == docs.count()


def test_tables_stored_as_one_file_or_as_a_folder(spark, docs, tmp_path):
    """The same rows, whichever way the named table lies beside others."""
    for name, of in (("folder", lambda p: docs.repartition(3).write.parquet(p)), ("file", None)):
        src, dst, mark = (str(tmp_path / name / n) for n in ("src", "dst", "mark"))
        docs.limit(3).write.parquet(f"{src}/others.parquet")
        if of:
            of(f"{src}/documents.parquet")
        else:
            shutil.copy("/root/testdata/sf0.001/documents.parquet", f"{src}/documents.parquet")
        stream_filter(spark, src, dst, mark, docs.schema, lambda d: d, glob="documents.parquet", files_per_trigger=1).awaitTermination()
        got = spark.read.parquet(dst)
        assert got.count() == docs.count() and got.exceptAll(docs).isEmpty(), name
