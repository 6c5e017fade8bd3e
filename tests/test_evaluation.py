import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import auc, held_out


def by_hand(rows):
    pos = [s for s, y in rows if y == 1 and s is not None and s == s]
    neg = [s for s, y in rows if y == 0 and s is not None and s == s]
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    return len(pos), len(neg), won / (len(pos) * len(neg)) if pos and neg else None


@pytest.mark.parametrize("values", [1, 3, 50, 10**9])
def test_auc_is_the_share_of_ordered_pairs(spark, values):
    rng = random.Random(values)
    rows = [(rng.randrange(values) + (0.2 * values * (y := rng.random() < 0.3)), int(y)) for _ in range(600)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(6)
    n_pos, n_neg, want = by_hand(rows)
    got = auc(df, "s", "y").first()
    assert (got.n_pos, got.n_neg) == (n_pos, n_neg) and got.auc == pytest.approx(want, abs=1e-12)


def test_odd_scores(spark):
    rows = [(1.0, 1), (None, 1), (float("nan"), 1), (float("nan"), 0), (0.0, 0), (-0.0, 1), (float("-inf"), 0), (float("inf"), 1), (2.0, None)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "s double, y int, pos int, score string")
    want = by_hand([(s, y) for s, y in rows if y is not None])
    got = auc(df, "s", "y").first()
    assert (got.n_pos, got.n_neg, got.auc) == pytest.approx(want)


def test_one_class_or_none(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "s long, y int")
    assert tuple(auc(df, "s", "y").first()) == (2, 0, None)
    assert tuple(auc(df.limit(0), "s", "y").first()) == (0, 0, None)
    with pytest.raises(ValueError, match="missing"):
        auc(df, "s", "label")


def test_sums_stay_exact_beyond_64_bits(spark):
    """A running total of tied classes far above what a double holds."""
    n = 2_000_000
    df = spark.range(n).select((F.col("id") % 2).alias("y"), (F.col("id") % 3).alias("s"))
    got = auc(df, "s", "y").first()
    # 0, 1 and 2 are not equally frequent: the two rows over are a negative with 0 and a positive with 1
    a = n // 6
    won = (a + 1) ** 2 + a * (2 * a + 1) + (2 * a * (a + 1) + a * a) / 2
    assert got.n_pos == got.n_neg == n // 2 and got.auc == pytest.approx(won / (n // 2) ** 2, abs=1e-12)


def test_the_fold_is_about_a_quarter_and_does_not_move(spark):
    df = spark.range(4000).select("id", held_out("id").alias("h"))
    assert 900 < df.where("h").count() < 1100
    assert {r.id for r in df.repartition(7).where("h").collect()} == {r.id for r in df.where("h").collect()}
    assert spark.sql("select cast(null as int) as id").select(held_out("id")).first()[0] is False
