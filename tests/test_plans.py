import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import heur_stats, token_stats
from textloom.plans import balanced_join, durable, lookup_join, range_scan, shared_folder, with_row_index


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_durable_survives_its_source(spark):
    df = durable(spark.range(5).withColumn("x", F.rand()), "t")
    assert df.orderBy("id").collect() == df.orderBy("id").collect()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_splits_heavy_keys(spark, how):
    rng = random.Random(1)
    keys = [0] * 400 + [1] * 90 + [rng.randrange(2, 40) for _ in range(110)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k int")
    right = spark.createDataFrame([(k, f"v{k}", keys.count(k)) for k in range(0, 30)], "k int, v string, w long")
    want = sorted(map(tuple, left.join(right.drop("w"), "k", how).select("i", "k", "v").collect()))
    split = lookup_join(left, right, ["k"], "w", how, heavy_floor=20)
    assert "__salt" in split._jdf.queryExecution().toString()
    assert sorted(map(tuple, split.select("i", "k", "v").collect())) == want
    balanced = balanced_join(left, right.drop("w"), ["k"], how, heavy_floor=20)
    assert sorted(map(tuple, balanced.select("i", "k", "v").collect())) == want


def test_row_index_is_dense_and_ordered(spark):
    keys = random.Random(2).sample(range(10_000), 500)
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(7)
    rows = with_row_index(df, "k").collect()
    assert sorted((r.row_idx, r.k) for r in rows) == list(enumerate(sorted(keys)))


@pytest.mark.parametrize("skip,take,want", [(0, 3, 3), (95, 10, 5), (100, 5, 0), (10, 0, 0), (40, 20, 20)])
def test_range_scan(spark, skip, take, want):
    df = spark.range(100).select((F.col("id") * 3).alias("k")).repartition(5)
    got = sorted(r.k for r in range_scan(df, "k", skip, take).collect())
    assert got == [3 * i for i in range(skip, skip + want)]


def test_missing_columns_fail_before_any_job(spark, docs):
    with pytest.raises(ValueError, match="missing"):
        heur_stats(docs, text_col="body")
    with pytest.raises(ValueError, match="missing"):
        token_stats(docs)


def test_column_pruning_and_pushdown(spark, docs):
    plan = range_scan(docs, "doc_id", 5, 10).select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id" in plan and "text" not in plan
