import pytest
from pyspark.sql import functions as F

from textloom.operators import chunk_words, concat_items

LENGTHS = [0, 1, 10, 37, 99, 100, 101, 250, 1234]


def by_steps(words, parts):
    out, at, step = [], 0.0, len(words) / parts
    while at < len(words):
        out.append(" ".join(words[int(at):int(at + step)]))
        at += step
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(n, " \t".join(f"w{i}" for i in range(n))) for n in LENGTHS] + [(-1, None)]
    return spark.createDataFrame(rows, "doc_id int, text string")


def collected(df):
    out = {}
    for r in df.orderBy("doc_id", "chunk_idx").collect():
        out.setdefault(r.doc_id, []).append(r.text)
    return out


@pytest.mark.parametrize("parts", [100, 7])
def test_drift_mode_equals_adding_up_a_step(spark, texts, parts):
    got = collected(chunk_words(texts, parts))
    want = {n: by_steps([f"w{i}" for i in range(n)], parts) for n in LENGTHS if n}
    assert got == want


def test_number_of_chunks_drifts_as_published(spark):
    df = spark.range(1, 6001).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), F.col("id").cast("int")).alias("text"))
    sizes = chunk_words(df).groupBy("doc_id").count().groupBy("count").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["count"]: r.n for r in sizes} == {100: 3178, 101: 2822}


def test_exact_mode(spark, texts):
    got = collected(chunk_words(texts, mode="exact"))
    for n in LENGTHS[1:]:
        assert len(got[n]) == 100
        assert " ".join(c for c in got[n] if c).split() == [f"w{i}" for i in range(n)]
    assert 0 not in got and -1 not in got


def test_empty_chunks_can_be_left_out(spark, texts):
    got = collected(chunk_words(texts, keep_empty=False))
    assert len(got[37]) == 37 and len(got[1]) == 1


def test_concat_items(spark):
    rows = [(1, 2, "b"), (1, 10, "c"), (1, 1, "a"), (1, 3, ""), (1, 4, None), (2, 1, ""), (3, 1, None)]
    df = spark.createDataFrame(rows, "k int, i int, text string")
    assert {r.k: r.text for r in concat_items(df, "k", "i").collect()} == {1: "a\n\nb\n\nc", 2: "", 3: ""}
    assert {r.k: r.text for r in concat_items(df, "k", "i", sep="", drop_empty=False).collect()} == {1: "abc", 2: "", 3: ""}
