"""Sharding by sampled splitters: size-weighted samples, quantile boundaries, ranges.

Records are ordered by a key of 63 bits, the checksum of the text followed by bits of the
id's hash, so copies lie together unless a border runs through them.  A size-weighted
sample of keys gives boundaries of many small ranges; ranges that turn out overfull are
sampled more densely and subdivided.  Exact sizes of the ranges place each of them in the
whole, and a running sum within a range gives every record its place in bytes, hence its
shard.  Only column expressions are used; the texts themselves are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from textloom.plans import durable

SHARDS = 16
RANGES = 16            # per shard
RANGE_ROWS = 1 << 20   # records of a range, about; more records make more ranges
RANGE_BYTES = 64 << 20  # text of a range, about, as whole rows may be sorted by range
MAX_RANGES = 1 << 14   # of all shards together, whatever the input
SAMPLES = 64           # keys drawn per range, on average
OVERFULL = 2           # times the mean
ROUNDS = 4             # of subdividing
LOOKUP_BITS = 12       # ranges are found by a join on the leading bits of the key
KEY_BITS = 63


def size_of(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long") + 1


def crc_of(text_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def _records(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, size, crc, key, copies)``: rows equal in all three are one record."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), size_of(text_col).alias("size"), crc_of(text_col).alias("crc"))
    return rows.groupBy("id", "size", "crc").agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "key", _key(F.col("crc"), F.col("id"))
    )


def _draw(records: DataFrame, rate: float, seed: int) -> list[tuple[int, float]]:
    """``(key, weight)`` of records drawn with a chance of ``rate`` per byte."""
    chance = F.col("size") * F.col("copies") * rate
    dice = F.pmod(F.xxhash64("key", "size", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    drawn = records.where(dice < chance).select("key", F.greatest(chance, F.lit(1.0)).alias("w"))
    return sorted((r["key"], r["w"]) for r in drawn.collect())  # about SAMPLES keys per range


def _quantiles(drawn: list[tuple[int, float]], parts: int) -> list[int]:
    """At most ``parts - 1`` keys that cut the drawn weight into equal parts."""
    total, done, cuts = sum(w for _, w in drawn), 0.0, []
    for key, w in drawn:
        if done >= total * (len(cuts) + 1) / parts and len(cuts) < parts - 1 and (not cuts or key > cuts[-1]):
            cuts.append(key)
        done += w
    return cuts


def _ranged(records: DataFrame, cuts: list[int]) -> DataFrame:
    """``records`` with ``range``: the number of cuts that are not above the key.

    The ranges are broadcast; there are at most ``MAX_RANGES`` times a constant, and each
    stands once under every prefix that it meets.
    """
    shift = KEY_BITS - LOOKUP_BITS
    lows, highs = [0, *cuts], [*cuts, 1 << KEY_BITS]
    rows = [
        (prefix, lo, hi - 1, k)
        for k, (lo, hi) in enumerate(zip(lows, highs)) for prefix in range(lo >> shift, (hi - 1 >> shift) + 1)
    ]
    ranges = records.sparkSession.createDataFrame(rows, "prefix long, lo long, hi long, range int")
    prefix = F.shiftright("key", shift)
    return records.join(
        F.broadcast(ranges), (prefix == ranges["prefix"]) & (F.col("key") >= ranges["lo"]) & (F.col("key") <= ranges["hi"])
    ).select(records["*"], "range")


def _splitters(records: DataFrame, shards: int, ranges: int) -> tuple[list[int], list]:
    """The cuts, and ``(range, bytes, rows)`` of the ranges they make."""
    total, rows = records.agg(
        F.sum(F.col("size") * F.col("copies")), F.count(F.lit(1))
    ).first()
    wanted = min(max(shards * ranges, -(-rows // RANGE_ROWS), -(-total // RANGE_BYTES)), MAX_RANGES)
    rate = wanted * SAMPLES / total
    cuts = _quantiles(_draw(records, rate, 0), wanted)
    mean = total / wanted
    for turn in range(ROUNDS + 1):
        found = _ranged(records, cuts).groupBy("range").agg(
            F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"),
            F.count(F.lit(1)).alias("records"),
        ).orderBy("range").collect()
        over = [r for r in found if r["bytes"] > OVERFULL * mean and r["records"] > 1]
        if turn == ROUNDS or not over:
            return cuts, found
        new: set[int] = set()
        inside = _ranged(records, cuts).where(F.col("range").isin([r["range"] for r in over]))
        drawn = _draw(inside, rate * 2 ** (turn + 1), turn + 1)
        edges = [0, *cuts, 1 << KEY_BITS]
        for r in over:
            own = [x for x in drawn if edges[r["range"]] <= x[0] < edges[r["range"] + 1]]
            new.update(_quantiles(own, -(-r["bytes"] // int(mean) or 1)))
        if not new - set(cuts):
            return cuts, found
        cuts = sorted({*cuts, *new})


def _key(crc: Column, ident: Column) -> Column:
    return F.shiftleft(crc, 31).bitwiseOR(F.shiftrightunsigned(F.xxhash64(ident), 33))


@dataclass(frozen=True)
class Plan:
    """Where the ranges lie: their cuts, and the bytes and rows before each."""

    cuts: list[int]
    places: DataFrame
    total: int


def _plan(records: DataFrame, shards: int, ranges: int) -> Plan:
    cuts, found = _splitters(records, shards, ranges)
    begins = accumulate((r["bytes"] for r in found), initial=0)
    firsts = accumulate((r["rows"] for r in found), initial=0)
    places = records.sparkSession.createDataFrame(
        [(r["range"], b, f) for r, b, f in zip(found, begins, firsts)], "range int, begin long, first long"
    )
    return Plan(cuts, places, sum(r["bytes"] for r in found))


def _shard_of(begin: Column, size: Column, total: int, shards: int) -> Column:
    """The middle of the record decides; decimals, as bytes times shards may not fit 64 bits."""
    middle = (2 * begin + size).cast("decimal(25,0)")
    shard = F.floor(middle * shards / F.lit(2 * total).cast("decimal(25,0)")).cast("int")
    return F.least(shard, F.lit(shards - 1))


_BEFORE = "OVER (PARTITION BY range ORDER BY key, size, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _placed(records: DataFrame, plan: Plan, shards: int) -> DataFrame:
    """``(id, size, crc, shard, row)`` of every row; stored."""
    rows = _ranged(records, plan.cuts).join(F.broadcast(plan.places), "range")
    size, copies = F.col("size"), F.col("copies")
    rows = rows.withColumn("begin", F.col("begin") + F.expr(f"sum(size * copies) {_BEFORE}") - size * copies).withColumn(
        "first", F.col("first") + F.expr(f"sum(copies) {_BEFORE}") - copies
    )
    each = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    shard = _shard_of(F.col("begin") + F.col("copy") * size, size, plan.total, shards)
    return durable(
        each.select("id", "size", "crc", shard.alias("shard"), (F.col("first") + F.col("copy")).alias("row")), "shard-rows"
    )


def _starts(placed: DataFrame) -> DataFrame:
    """One row per shard: the number of rows before it."""
    return placed.groupBy("shard").agg(F.min("row").alias("start"))


def assign_shards(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES,
) -> DataFrame:
    """``(id_col, size, text_crc32, shard, slot)`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text counts as empty).  Every shard
    gets the same bytes, up to one record at either end; a record of more than that takes a
    shard and leaves the next ones emptier.  ``slot`` numbers a shard's rows from 0 without
    gaps.  Rows equal in id and text get a place each, one after another; null ids are ids
    like others.  Other columns are ignored; an empty table gives an empty one.
    """
    records = durable(_records(docs, id_col, text_col), "shard-records")
    if records.isEmpty():
        return records.select(
            F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(0).alias("shard"),
            F.lit(0).cast("long").alias("slot"),
        )
    placed = _placed(records, _plan(records, shards, ranges), shards)
    return placed.join(F.broadcast(_starts(placed)), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("start")).alias("slot")
    )


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES,
) -> DataFrame:
    """``docs`` range-partitioned by shard, with ``shard`` and ``slot``, which replace columns of
    these names; the same places that ``assign_shards`` gives.

    The whole rows are shuffled once, by range.  Rows equal in id and text share a range,
    whatever their number, and take their slots in any order.
    """
    keep = [c for c in docs.columns if c not in ("shard", "slot")]
    records = durable(_records(docs, id_col, text_col), "shard-records")
    if records.isEmpty():
        return docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    plan = _plan(records, shards, ranges)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{id_col}`").alias("id"),
        size_of(text_col).alias("size"), _key(crc_of(text_col), F.col(f"`{id_col}`")).alias("key"),
    )
    rows = _ranged(rows, plan.cuts).join(F.broadcast(plan.places), "range")
    begin = F.col("begin") + F.expr(f"sum(size) {_BEFORE}") - F.col("size")
    rows = rows.withColumn("at", F.col("first") + F.expr(f"count(1) {_BEFORE}") - 1).withColumn(
        "shard", _shard_of(begin, F.col("size"), plan.total, shards)
    )
    starts = _starts(_placed(records, plan, shards))
    return rows.join(F.broadcast(starts), "shard").select(
        *[F.col("row")[c].alias(c) for c in keep], "shard", (F.col("at") - F.col("start")).alias("slot")
    )
