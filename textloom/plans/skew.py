"""Joins that stay balanced when one key holds a large share of the rows.

``lookup_join`` attaches a table with one row per key to a table in which a key
may repeat without limit.  A key above ``1 / MAX_HEAVY`` of all rows is split: its
rows are dealt over several salts and its single lookup row is repeated once per
salt.  Only the list of such keys is broadcast, and there cannot be more than
``MAX_HEAVY`` of them; the looked-up values always travel by shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from textloom.plans.lineage import durable

MAX_HEAVY = 4096          # most keys ever broadcast
HEAVY_FLOOR = 1_000_000   # a key with fewer rows than this is never split
SMALL_BYTES = 64 << 20    # a table of at most this size cannot overload a task


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of a frame; for a stored table, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    weight: str,
    how: str = "inner",
    heavy_floor: int | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``on``) without a hot reducer.

    ``right[weight]`` is the number of ``left`` rows that carry the key.  Weights are
    looked at only when ``left`` is large enough to matter, or ``heavy_floor`` is given.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    on = list(on)
    plain = right.drop(weight)
    if heavy_floor is None and planned_bytes(left) <= SMALL_BYTES:
        return left.join(plain, on, how)
    floor = HEAVY_FLOOR if heavy_floor is None else heavy_floor
    total, top = right.agg(F.sum(weight), F.max(weight)).first()
    limit = max(floor, (total or 0) // MAX_HEAVY)
    if top is None or top <= limit:
        return left.join(plain, on, how)
    parts = F.when(F.col(weight) > limit, F.ceil(F.col(weight) / limit)).otherwise(1).cast("long")
    heavy = right.where(F.col(weight) > limit).select(*on, parts.alias("__parts"))
    dealt = left.join(F.broadcast(heavy), on, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*hashable(left)), F.coalesce("__parts", F.lit(1)))
    ).drop("__parts")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    copies = right.withColumn("__salt", salts).drop(weight)
    return dealt.join(copies, [*on, "__salt"], how).drop("__salt")


def hashable(df: DataFrame) -> list[str]:
    """The columns that can be hashed: those without a map inside."""
    return [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]


def key_weights(df: DataFrame, on: Sequence[str], weight: str) -> DataFrame:
    """Rows per key; the map side counts first, so a hot key costs one row per task."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias(weight))


def balanced_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", heavy_floor: int | None = None
) -> DataFrame:
    """``lookup_join`` for callers who have no counts yet: keys of a large ``left`` are
    counted first.  ``left`` should be a stored table, as it is then read twice."""
    if heavy_floor is None and planned_bytes(left) <= SMALL_BYTES:
        return left.join(right, list(on), how)
    weighted = key_weights(left, on, "__w").join(right, list(on), how)
    return lookup_join(left, durable(weighted, "weighted"), on, "__w", how, heavy_floor)
