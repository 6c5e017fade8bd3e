import numpy as np
from pyspark.sql import functions as F

from textloom import functions as X
from textloom.operators import truncate_pad


def test_top1_takes_the_first_on_a_tie(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7],), ([0.5],), ([3.0, 1.0],), (None,)], "s array<double>")
    assert [r[0] for r in df.select(X.top1("s")).collect()] == [1, 0, 0, None]


def test_softmax(spark):
    rows = [[1.0, 2.0, 3.0], [1000.0, 1000.0], [-5.0]]
    df = spark.createDataFrame([(r,) for r in rows], "s array<double>")
    for got, r in zip(df.select(X.softmax("s")).collect(), rows):
        e = np.exp(np.array(r) - max(r))
        assert np.allclose(got[0], e / e.sum())


def test_label_of(spark):
    df = spark.createDataFrame([(0,), (1,), (9,), (None,)], "c int")
    assert [r[0] for r in df.select(X.label_of("c", {0: "a", 1: "b"})).collect()] == ["a", "b", None, None]


def test_truncate_pad(spark):
    df = spark.createDataFrame([(1, [5, 6]), (2, [1, 2, 3, 4, 5]), (3, [])], "doc_id int, input_ids array<int>")
    got = {r.doc_id: (r.input_ids, r.attention_mask) for r in truncate_pad(df, 0, 4).collect()}
    assert got == {1: ([5, 6, 0, 0], [1, 1, 0, 0]), 2: ([1, 2, 3, 4], [1, 1, 1, 1]), 3: ([0] * 4, [0] * 4)}


def test_clm_labels_hide_padding(spark):
    df = spark.createDataFrame([([5, 0, 6, 0],)], "ids array<int>")
    assert df.select(X.clm_labels("ids", 0)).first()[0] == [5, -100, 6, -100]
    assert df.select(X.attention_mask(F.col("ids"), 3)).first()[0] == [1, 1, 1]
