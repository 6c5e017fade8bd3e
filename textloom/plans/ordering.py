"""Global row numbers without a single-task window.

The key column alone is range-partitioned and sorted, so every task numbers its
own slice; the slices' lengths (one number per partition) give the offsets.  Running
totals work alike.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.plans.checks import require_absent
from textloom.plans.lineage import durable

_SLICE_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def _slices(df: DataFrame, keys: tuple[Column | str, ...]) -> DataFrame:
    """``df`` in sorted slices by ranges of ``keys``, stored: ``__slice`` and ``__pos`` in it."""
    order = [F.col(k) if isinstance(k, str) else k for k in keys]
    return durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__mid", F.monotonically_increasing_id())
        .withColumn("__slice", F.shiftright("__mid", _SLICE_BITS))
        .withColumn("__pos", F.col("__mid").bitwiseAND((1 << _SLICE_BITS) - 1)),
        "row-index",
    )


def with_row_index(df: DataFrame, *keys: Column | str, name: str = "row_idx") -> DataFrame:
    """``df`` with a dense 0-based index in the order of ``keys`` (unique together).

    The indexed rows are stored before they are counted, so a re-run of a lost
    task cannot shift the numbers.  Pass narrow frames: everything in ``df`` is
    shuffled once.
    """
    require_absent(df, name)
    slices = _slices(df, keys)
    sizes = slices.groupBy("__slice").count().orderBy("__slice").collect()
    starts = [0, *accumulate(r["count"] for r in sizes)]
    rows = [(r["__slice"], s) for r, s in zip(sizes, starts)]
    offsets = df.sparkSession.createDataFrame(rows, "__slice bigint, __start bigint")
    return (
        slices.join(F.broadcast(offsets), "__slice")
        .withColumn(name, F.col("__start") + F.col("__pos"))
        .drop("__slice", "__mid", "__pos", "__start")
    )


def with_running_total(
    df: DataFrame, value: str, *keys: Column | str, name: str = "before", index: str = "row_idx"
) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` (whole numbers, not null) over all rows
    before this one in the order of ``keys`` (unique together), and the row's ``index``.

    Two levels: every slice of the range partition adds up its own rows in a window, and
    the slices' totals, one number per partition, give the bases.  No window without
    partitions.  Pass narrow frames, as for ``with_row_index``.
    """
    require_absent(df, name, index)
    slices = _slices(df, keys)
    totals = slices.groupBy("__slice").agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("v")).orderBy("__slice").collect()
    starts = [0, *accumulate(r["n"] for r in totals)]
    bases = [0, *accumulate(r["v"] for r in totals)]
    rows = [(r["__slice"], s, b) for r, s, b in zip(totals, starts, bases)]
    offsets = df.sparkSession.createDataFrame(rows, "__slice bigint, __start bigint, __base bigint")
    earlier = Window.partitionBy("__slice").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slices.withColumn("__sum", F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        .join(F.broadcast(offsets), "__slice")
        .withColumns({name: F.col("__base") + F.col("__sum"), index: F.col("__start") + F.col("__pos")})
        .drop("__slice", "__mid", "__pos", "__start", "__base", "__sum")
    )


def range_scan(df: DataFrame, key: str, skip: int, take: int) -> DataFrame:
    """Rows ``skip`` .. ``skip + take - 1`` in the order of the unique column ``key``.

    Only the key column is read and sorted, to find the two border keys; the wide
    rows are then read by a key range that reaches the scan as a pushed filter.
    """
    if skip < 0 or take < 0:
        raise ValueError("skip and take must not be negative")
    if take == 0:
        return df.where(F.lit(False))
    index = with_row_index(df.select(F.col(key).alias("k")), "k")
    borders = {
        r["row_idx"]: r["k"]
        for r in index.where(F.col("row_idx").isin(skip, skip + take)).collect()
    }
    if skip not in borders:
        return df.where(F.lit(False))
    rows = df.where(F.col(key) >= F.lit(borders[skip]))
    if skip + take in borders:
        rows = rows.where(F.col(key) < F.lit(borders[skip + take]))
    return rows
