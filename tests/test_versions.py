import threading

import pytest
from pyspark.sql import functions as F

from textloom.sources import publish_version, published_versions, read_version
from textloom.sources import versions as module


def ids(df):
    return sorted(r.id for r in df.collect())


def test_readers_see_the_newest_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_version(spark, path)
    assert published_versions(spark, path) == []
    assert publish_version(spark.range(5), path) == 1
    first = read_version(spark, path)
    assert publish_version(spark.range(3).withColumn("x", F.lit("é")), path) == 2
    assert ids(first) == [0, 1, 2, 3, 4] and ids(read_version(spark, path, 1)) == [0, 1, 2, 3, 4]
    assert read_version(spark, path).columns == ["id", "x"] and ids(read_version(spark, path)) == [0, 1, 2]
    with pytest.raises(FileNotFoundError, match="version 7"):
        read_version(spark, path, 7)


def test_a_table_can_be_cleaned_into_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_version(spark.range(10), path)
    publish_version(read_version(spark, path).where("id % 2 = 0"), path)
    assert ids(read_version(spark, path)) == [0, 2, 4, 6, 8] and ids(read_version(spark, path, 1)) == list(range(10))


def test_a_run_broken_before_the_commit_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish_version(spark.range(4), path, run="monday")

    def broken(self, name, content):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(module._Store, "create", broken)
        with pytest.raises(RuntimeError):
            publish_version(spark.range(9), path, run="tuesday")
    assert ids(read_version(spark, path)) == [0, 1, 2, 3] and len(published_versions(spark, path)) == 1
    assert publish_version(spark.range(9), path, run="tuesday") == 2 and len(ids(read_version(spark, path))) == 9


def test_a_run_that_fails_while_writing_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_version(spark.range(4), path)
    with pytest.raises(Exception, match="boom|raise_error|USER_RAISED"):
        publish_version(spark.range(100).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("boom"))).otherwise(F.lit("y"))), path)
    assert ids(read_version(spark, path)) == [0, 1, 2, 3]


def test_a_marker_that_was_never_finished_is_skipped(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_version(spark.range(4), path)
    (tmp_path / "t" / "versions" / "0000000002").write_text('{"version": 2, "fol')
    assert ids(read_version(spark, path)) == [0, 1, 2, 3] and [v.number for v in published_versions(spark, path)] == [1]
    assert publish_version(spark.range(6), path) == 3 and ids(read_version(spark, path)) == list(range(6))


def test_the_same_run_writes_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish_version(spark.range(4), path, run="a") == 1
    assert publish_version(spark.range(5), path, run="b") == 2
    assert publish_version(spark.range(99), path, run="a") == 1
    assert [v.run for v in published_versions(spark, path)] == ["a", "b"]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_writers_at_once_get_different_numbers(spark, tmp_path):
    path, got = str(tmp_path / "t"), []
    threads = [threading.Thread(target=lambda k=k: got.append((publish_version(spark.range(k), path), k))) for k in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(n for n, _ in got) == [1, 2, 3]
    assert all(read_version(spark, path, n).count() == k for n, k in got)


def test_an_empty_table_is_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_version(spark.range(3), path)
    publish_version(spark.range(0), path)
    assert read_version(spark, path).count() == 0 and read_version(spark, path).columns == ["id"]
