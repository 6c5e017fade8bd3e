"""How well scores separate two classes on rows that the model has not seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textloom.plans.checks import require_columns
from textloom.plans.ordering import with_running_total


def held_out(key: Column | str, sixteenths: int = 4) -> Column:
    """Whether a row belongs to the fold that is kept for the check: by the first digit of its
    key's MD5, so that the fold depends on neither the order nor the range of the keys.  A
    null key is never held out."""
    key = F.col(key) if isinstance(key, str) else key
    digit = F.substring(F.md5(key.cast("string").cast("binary")), 1, 1)
    return F.coalesce(F.conv(digit, 16, 10).cast("int") < sixteenths, F.lit(False))


def auc(df: DataFrame, score_col: str, label_col: str, positive=1) -> DataFrame:
    """``(n_pos, n_neg, auc)``: how often a positive row's score is above a negative one's,
    equal scores counting half.

    Rows without a score (null or NaN) or without a label are left out; ``auc`` is null if one
    class has no rows.  Equal scores are counted first, combined on the map side, so one score
    that most rows share costs a row per task.  Each score then needs the negatives below it:
    a running total over ranges of scores.  Sums are whole numbers and exact.
    """
    require_columns(df, score_col, label_col)
    score, label = F.col(score_col), F.col(label_col)
    known = score.isNotNull() & label.isNotNull() & ~F.isnan(score.cast("double"))
    is_pos = label == F.lit(positive)
    counts = df.where(known).groupBy(score.alias("score")).agg(
        F.count_if(is_pos).alias("pos"), F.count_if(~is_pos).alias("neg")
    )
    ranked = with_running_total(counts, "neg", "score", name="below")
    wide = "decimal(19,0)"
    halves = F.col("pos").cast(wide) * (2 * F.col("below") + F.col("neg")).cast(wide)
    sums = ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("n_pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n_neg"), F.sum(halves).alias("won")
    )
    pairs = 2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return sums.select("n_pos", "n_neg", F.when(pairs > 0, F.col("won").cast("double") / pairs).alias("auc"))
