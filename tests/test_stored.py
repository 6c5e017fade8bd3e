import random

import pytest
from pyspark.sql import functions as F

from textloom.sources import file_rows, range_scan_stored, with_stored_index, write_in_order, zip_stored
from textloom.sources import stored as module


@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    """Files of uneven length, empty ones among them, in which nothing is sorted."""
    path = str(tmp_path_factory.mktemp("stored") / "n u m")
    rng = random.Random(5)
    values = rng.sample(range(10_000), 500)
    at = 0
    for k, n in enumerate([3, 0, 120, 1, 0, 200, 76, 100]):
        df = spark.createDataFrame([(v, "x" * 50) for v in values[at:at + n]], "v int, pad string").coalesce(1)
        df.write.parquet(f"{path}/d={k}")
        at += n
    return path, values


def test_index_is_the_place(spark, numbers):
    path, values = numbers
    rows = with_stored_index(spark.read.parquet(path)).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.row_idx)] == values
    assert sorted(r.row_idx for r in rows) == list(range(500))
    files = file_rows(spark.read.parquet(path)).orderBy("file").collect()
    assert [(r.n, r.start) for r in files if r.n] == [(3, 0), (120, 3), (1, 123), (200, 124), (76, 324), (100, 400)]


def test_index_with_many_files(spark, numbers, monkeypatch):
    path, values = numbers
    monkeypatch.setattr(module, "MAX_SHIPPED_FILES", 2)
    df = with_stored_index(spark.read.parquet(path))
    assert [r.v for r in df.orderBy("row_idx").collect()] == values


@pytest.mark.parametrize("skip,take", [(0, 3), (2, 2), (0, 500), (123, 1), (124, 200), (130, 250), (499, 10), (500, 5), (7, 0), (900, 3)])
def test_range(spark, numbers, skip, take):
    path, values = numbers
    got = range_scan_stored(spark.read.parquet(path), skip, take)
    assert sorted(r.v for r in got.collect()) == sorted(values[skip:skip + take])


def files_read(df):
    """The number of files that the scan of a plan opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]


def test_only_files_of_the_range_are_read(spark, numbers):
    path, _ = numbers
    df = spark.read.parquet(path)
    assert files_read(df.select("v"))[0] >= 6
    assert files_read(range_scan_stored(df, 130, 100).select("v")) == [1]
    assert files_read(range_scan_stored(df, 320, 10).select("v")) == [2]
    plan = range_scan_stored(df, 130, 100).select("v")._jdf.queryExecution().executedPlan().toString()
    assert "pad" not in plan and "Exchange" not in plan and "Sort" not in plan


def test_a_frame_without_files_has_no_place(spark):
    with pytest.raises(ValueError, match="place"):
        with_stored_index(spark.range(3))
    with pytest.raises(ValueError):
        range_scan_stored(spark.range(3), -1, 2)


def test_zip(spark, numbers, tmp_path):
    path, values = numbers
    other = str(tmp_path / "other")
    scores = spark.createDataFrame(list(enumerate(v % 7 for v in values)), "i int, score int").repartition(3)
    write_in_order(scores, other, "i")
    left = spark.read.parquet(path)
    rows = zip_stored(left, spark.read.parquet(other)).collect()
    assert len(rows) == 500 and all(r.score == r.v % 7 and r.i == values.index(r.v) for r in rows)
    short = str(tmp_path / "short")
    write_in_order(scores.where("i < 499"), short, "i")
    with pytest.raises(ValueError, match="500 and 499"):
        zip_stored(left, spark.read.parquet(short))
    with pytest.raises(ValueError):
        zip_stored(left, left)


def test_written_order_is_kept_whatever_came_in(spark, tmp_path):
    df = spark.range(2000).select("id", F.xxhash64("id").alias("h")).repartition(7)
    path = write_in_order(df, str(tmp_path / "o"), F.col("h").desc())
    got = with_stored_index(spark.read.parquet(path)).orderBy("row_idx").collect()
    assert [r.h for r in got] == sorted((r.h for r in got), reverse=True)
