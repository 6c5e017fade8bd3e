"""Corpus-wide near-duplicate removal: MinHash signatures, banding, components.

A document is represented by the minima of ``num_perm`` linear permutations over its
word shingles.  ``b`` bands of ``r`` minima each are bucket keys; documents that meet
in a bucket belong to one cluster, and the smallest id of a cluster stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textloom.operators.components import components
from textloom.plans.barrier import computed
from textloom.plans.checks import require_columns
from textloom.plans.lexicon import flat_lists, row_parts, text_parts, to_lists, word_lists
from textloom.plans.lineage import durable
from textloom.plans.skew import key_weights, lookup_join

PRIME = (1 << 31) - 1
# The usual parameters of the command-line tool.
NUM_PERM, THRESHOLD, BANDS, ROWS, NGRAM = 112, 0.75, 14, 8, 5
HASHES_AT_ONCE = 1 << 15   # hashes that are permuted together: they stay in a core's cache
PAIRS_AT_ONCE = 1_000_000  # pairs that one shingle of a bucket may make in a task


def _hex32(s: str) -> int:
    return int(hashlib.md5(s.encode("utf-8")).hexdigest()[:8], 16)


def permutations(num_perm: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and shifts of the permutations, derived from their number."""
    mul = [1 + _hex32(f"mul{i}") % (PRIME - 1) for i in range(num_perm)]
    add = [_hex32(f"add{i}") % PRIME for i in range(num_perm)]
    return np.array(mul, dtype=np.int64), np.array(add, dtype=np.int64)


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.array([_hex32(w) % PRIME for w in words], dtype=np.int64)


def _permuted(hashes: np.ndarray, mul: int, add: int) -> np.ndarray:
    """``(hashes * mul + add) % PRIME``: numpy divides by one number several times faster than it
    takes a remainder."""
    out = hashes * np.uint64(mul)
    out += np.uint64(add)
    whole = out // np.uint64(PRIME)
    whole *= np.uint64(PRIME)
    out -= whole
    return out


def _sets(texts: pa.Array, n: int, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(i, j, hashes, offsets)``: the distinct n-gram hashes of rows ``i:j``, sorted by row.

    Words are hashed once per slice; all else runs over the words of many rows, about ``most``, at once.
    """
    factors = np.array([1 + _hex32(f"pos{j}") % (PRIME - 1) for j in range(n)], dtype=np.int64)
    found, at, _ = word_lists(texts)
    coded = found.dictionary_encode()
    known = _word_hashes(coded.dictionary.to_pylist())
    h = known[coded.indices.to_numpy(zero_copy_only=False)] if len(found) else np.zeros(0, np.int64)
    for i, j in row_parts(at, most):
        counts = np.maximum(np.diff(at[i:j + 1]) - n + 1, 0)
        row = np.repeat(np.arange(j - i), counts)
        first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(at[i:j], counts)
        mixed = np.zeros(len(first), np.int64)
        for k in range(n):
            mixed += h[first + k] * factors[k] % PRIME
        mixed %= PRIME
        order = np.lexsort((mixed, row))
        row, mixed = row[order], mixed[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (mixed[1:] != mixed[:-1])
        row, mixed = row[new], mixed[new]
        yield i, j, mixed, np.searchsorted(row, np.arange(j - i + 1))


def shingles(df: DataFrame, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, shingles)``: the distinct hashes of a document's word n-grams."""
    require_columns(df, id_col, text_col)

    @F.arrow_udf("array<int>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in chain.from_iterable(map(text_parts, parts)):
            valid = texts.is_valid().to_numpy(zero_copy_only=False)
            done = list(_sets(texts, n))
            sizes = np.concatenate([np.diff(d[3]) for d in done]) if done else np.zeros(0, np.int64)
            items = np.concatenate([d[2] for d in done]) if done else np.zeros(0, np.int64)
            yield to_lists(items, np.concatenate([[0], np.cumsum(sizes)]), valid, pa.int32())

    return computed(df, {"__s": run(F.col(text_col))}, [id_col]).withColumnRenamed("__s", "shingles")


def signatures(
    df: DataFrame, num_perm: int = NUM_PERM, n: int = NGRAM, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id_col, signature, *keep)``; null for a text of fewer than ``n`` words."""
    require_columns(df, id_col, text_col, *keep)

    @F.arrow_udf("array<int>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mul, add = permutations(num_perm)
        for texts in chain.from_iterable(map(text_parts, parts)):
            low = np.zeros((len(texts), num_perm), np.uint64)
            some = np.zeros(len(texts), bool)
            for i, j, hashes, at in _sets(texts, n, HASHES_AT_ONCE):
                full = np.flatnonzero(np.diff(at))
                some[i + full] = True
                if len(full):
                    unsigned = hashes.astype(np.uint64)
                    for k in range(num_perm):
                        low[i + full, k] = np.minimum.reduceat(_permuted(unsigned, mul[k], add[k]), at[full])
            sizes = np.where(some, num_perm, 0)
            yield to_lists(low[some].ravel().astype(np.int64), np.concatenate([[0], np.cumsum(sizes)]), some, pa.int32())

    return computed(df, {"__s": run(F.col(text_col))}, [id_col, *keep]).select(id_col, F.col("__s").alias("signature"), *keep)


def _band_keys(b: int, r: int, *scope: str) -> list[Column]:
    digits = F.col("signature").cast("array<string>")
    own = [F.col(c).cast("string") for c in scope]
    return [F.md5(F.concat_ws(",", F.slice(digits, i * r + 1, r), *own).cast("binary")) for i in range(b)]


def _check_bands(num_perm: int, b: int, r: int) -> None:
    if b * r > num_perm or b < 1 or r < 1:
        raise ValueError(f"{b} bands of {r} rows need {b * r} permutations, there are {num_perm}")


def bands(signatures: DataFrame, b: int = BANDS, r: int = ROWS, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, band, key)``: ``b`` bucket keys per signed document."""
    require_columns(signatures, id_col, "signature")
    signed = signatures.where("signature is not null")
    return signed.select(id_col, F.posexplode(F.array(*_band_keys(b, r))).alias("band", "key"))


def _stars(banded: DataFrame, id_col: str, heavy_floor: int | None) -> DataFrame:
    buckets = (
        banded.groupBy("band", "key")
        .agg(F.min(id_col).alias("b"), F.count(F.lit(1)).alias("w"))
        .where("w > 1")
    )
    joined = lookup_join(banded, durable(buckets, "buckets"), ["band", "key"], "w", heavy_floor=heavy_floor)
    return joined.where(F.col(id_col) != F.col("b")).select(F.col(id_col).alias("a"), "b").distinct()


def candidates(banded: DataFrame, id_col: str = "doc_id", heavy_floor: int | None = None) -> DataFrame:
    """``(a, b)``: each bucket member ``a`` with the smallest id ``b`` of its bucket.

    One edge per member keeps a bucket's cost linear, and joins exactly the documents
    that all pairs of the bucket would join.
    """
    require_columns(banded, id_col, "band", "key")
    return _stars(durable(banded, "bands"), id_col, heavy_floor)


def jaccard(pairs: DataFrame, sets: DataFrame, id_col: str = "doc_id", heavy_floor: int | None = None) -> DataFrame:
    """``pairs (a, b, ...)`` with the exact Jaccard similarity of their shingle sets.

    ``b`` may be one document for many pairs; its rows are split over tasks.
    """
    require_columns(pairs, "a", "b")
    require_columns(sets, id_col, "shingles")
    pairs = durable(pairs, "pairs")
    left = pairs.join(sets.select(F.col(id_col).alias("a"), F.col("shingles").alias("sa")), "a")
    right = key_weights(pairs, ["b"], "w").join(
        sets.select(F.col(id_col).alias("b"), F.col("shingles").alias("sb")), "b"
    )
    both = lookup_join(left, right, ["b"], "w", heavy_floor=heavy_floor)
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select(*pairs.columns, (shared / (F.size("sa") + F.size("sb") - shared)).alias("jaccard"))


def slot_similarity(
    pairs: DataFrame, signatures: DataFrame, id_col: str = "doc_id", heavy_floor: int | None = None
) -> DataFrame:
    """``pairs (a, b, ...)`` with ``estimate``, the share of equal slots of their signatures.

    No shingle is looked at: two rows of numbers travel for a pair and are compared as flat
    arrays, many pairs at once.  With n slots the estimate's standard error is at most
    1 / (2 sqrt(n)).  A pair without both signatures (a text too short for a shingle) has none.
    """
    require_columns(pairs, "a", "b")
    require_columns(signatures, id_col, "signature")

    @F.arrow_udf("int")
    def equal_slots(left: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in left:
            (x, at, _), (y, to, _) = flat_lists(a), flat_lists(b)
            if not np.array_equal(at, to):
                raise ValueError("signatures of unequal length")
            same = (x.to_numpy(zero_copy_only=False) == y.to_numpy(zero_copy_only=False)).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(same)])
            yield pa.array((ends[at[1:]] - ends[at[:-1]]).astype(np.int32))

    pairs = durable(pairs, "pairs")
    signed = signatures.where("signature is not null")
    left = pairs.join(signed.select(F.col(id_col).alias("a"), F.col("signature").alias("sa")), "a")
    right = key_weights(pairs, ["b"], "w").join(signed.select(F.col(id_col).alias("b"), F.col("signature").alias("sb")), "b")
    both = lookup_join(left, right, ["b"], "w", heavy_floor=heavy_floor)
    return both.select(*pairs.columns, (equal_slots("sa", "sb") / F.size("sa")).alias("estimate"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_copies)``: the smallest id of every distinct text.  Digests are
    combined before the shuffle, so a text copied without end costs a row per task."""
    require_columns(df, id_col, text_col)
    return (
        df.where(F.col(text_col).isNotNull()).select(id_col, F.md5(F.col(text_col).cast("binary")).alias("__d"))
        .groupBy("__d").agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("n_copies"))
        .select(id_col, "n_copies")
    )


def _same_signature(
    df: DataFrame, num_perm: int, b: int, r: int, n: int, id_col: str, text_col: str,
    scope_col: str | None, heavy_floor: int | None,
) -> tuple[DataFrame, DataFrame]:
    """Band rows of one document per distinct signature, and edges from the others.

    Copies share every band, so they are folded by one combined aggregate before any
    bucket is formed.  Texts too short for a shingle are folded by their own digest.
    """
    scope = [] if scope_col is None else [scope_col]
    own = [F.col(c).cast("string") for c in scope]
    digest = F.md5(F.concat_ws("/", F.md5(F.col(text_col).cast("binary")), *own).cast("binary"))
    text = df.where(F.col(text_col).isNotNull()).withColumn("__digest", digest)
    signed = signatures(text, num_perm, n, id_col, text_col, (*scope, "__digest"))
    # 16 bytes per key instead of 32 hexadecimal digits: this is what gets shuffled
    keys = F.when(
        F.col("signature").isNotNull(), F.array(*[F.unhex(k) for k in _band_keys(b, r, *scope)])
    ).otherwise(F.array(F.unhex("__digest")))
    rows = durable(
        signed.select(F.col(id_col).alias("id"), keys.alias("keys"), F.col("signature").isNull().alias("short")),
        "band-keys",
    )
    groups = durable(
        rows.groupBy("short", "keys").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")), "signatures"
    )
    copies = lookup_join(rows, groups.where("w > 1"), ["short", "keys"], "w", heavy_floor=heavy_floor)
    edges = copies.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    banded = groups.where("not short").select(F.col("rep").alias("id"), F.posexplode("keys").alias("band", "key"))
    return banded, edges


def _verified(
    met: DataFrame, sets: DataFrame, id_col: str, threshold: float, heavy_floor: int | None
) -> DataFrame:
    """Edges that join exactly what all similar pairs of all buckets would join.

    First each member is compared with its bucket's smallest id.  Then only members that
    lie outside their bucket's largest cluster are left; they meet the bucket's other
    clusters through their prefix shingles: of two sets at the threshold, the first
    ``n - ceil(threshold n) + 1`` elements in any common order always share one, so members
    that are unlike do not meet, and no number of rounds depends on the size of a bucket.
    The order is that of rising frequency (``_prefixes``): a shingle that most members have
    stands last and leaves the prefixes.  Members that still meet in great numbers are dealt
    over several tasks (``_meeting``).
    """
    stars = durable(jaccard(_stars(met, "id", heavy_floor), sets, id_col, heavy_floor), "judged")
    near = stars.where(F.col("jaccard") >= threshold).select("a", "b")
    found = components(near, heavy_floor=heavy_floor).withColumnRenamed("cluster", "c")
    placed = durable(
        met.join(found, "id", "left").select("band", "key", "id", F.coalesce("c", "id").alias("cluster")), "placed"
    )
    sizes = placed.groupBy("band", "key", "cluster").agg(F.count(F.lit(1)).alias("w"))
    mains = durable(
        sizes.groupBy("band", "key").agg(
            F.max_by("cluster", F.struct("w", "cluster")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("w").alias("w")
        ).where("parts > 1").drop("parts"),
        "open-buckets",
    )
    rows = lookup_join(placed, mains, ["band", "key"], "w", heavy_floor=heavy_floor)
    heads = _prefixes(sets.withColumnRenamed(id_col, "id").join(rows.select("id").distinct(), "id", "left_semi"), threshold, heavy_floor)
    rows = durable(
        rows.join(heads, "id").select(
            "band", "key", "id", "cluster", (F.col("cluster") != F.col("main")).alias("stray"), F.explode("prefix").alias("e")
        ),
        "prefixes",
    )
    late = jaccard(_meeting(rows, heavy_floor), sets, id_col, heavy_floor).where(F.col("jaccard") >= threshold).select("a", "b")
    return near.unionByName(late)


def _prefixes(sets: DataFrame, threshold: float, heavy_floor: int | None) -> DataFrame:
    """``(id, prefix)``: the rarest ``n - ceil(threshold n) + 1`` of the n shingles of every set."""
    spread = durable(sets.select("id", F.explode("shingles").alias("e")), "set-elements")
    counts = durable(spread.groupBy("e").agg(F.count(F.lit(1)).alias("f")).withColumn("w", F.col("f")), "set-counts")
    ranked = lookup_join(spread, counts, ["e"], "w", heavy_floor=heavy_floor)
    ordered = ranked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("f", "e"))).alias("s"))
    size = F.size("s")
    prefix = F.slice("s", 1, size - F.ceil(F.lit(threshold) * size).cast("int") + 1)
    return ordered.select("id", F.transform(prefix, lambda x: x["e"]).alias("prefix"))


def _meeting(rows: DataFrame, heavy_floor: int | None) -> DataFrame:
    """``(a, b)``: members of different clusters of a bucket that share a prefix shingle ``e``, one
    of them outside the largest cluster.

    Where ``w`` members, ``s`` of them outside, share one, the members are dealt over tasks by
    their ids and the ``s`` visit every share, so no task makes more than ``PAIRS_AT_ONCE`` pairs
    or so of one shingle."""
    meet = ["band", "key", "e"]
    groups = rows.groupBy(*meet).agg(F.count(F.lit(1)).alias("w"), F.count_if("stray").alias("s")).where("s > 0 and w > 1")
    shares = F.least("w", F.ceil(F.col("w") * F.col("s") / (heavy_floor or PAIRS_AT_ONCE))).cast("long")
    groups = durable(groups.withColumn("shares", shares), "meetings")
    outside = lookup_join(rows.where("stray"), groups.drop("w"), meet, "s", heavy_floor=heavy_floor)
    visits = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))
    left = outside.select(*meet, F.col("id").alias("a"), F.col("cluster").alias("ca"), visits.alias("share"))
    right = lookup_join(rows, groups.drop("s"), meet, "w", heavy_floor=heavy_floor).withColumn("share", F.pmod(F.xxhash64("id"), "shares"))
    return (
        left.join(right, [*meet, "share"]).where("ca <> cluster and (not stray or a > id)")
        .select("a", F.col("id").alias("b")).distinct()
    )


def bands_for(threshold: float, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """Bands and rows whose turning point ``(1 / b) ** (1 / r)`` lies nearest the threshold."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must lie in (0, 1]")
    fits = [(num_perm // r, r) for r in range(1, num_perm + 1)]
    return min(fits, key=lambda x: (abs((1 / x[0]) ** (1 / x[1]) - threshold), x[1]))


def duplicate_clusters(
    df: DataFrame,
    num_perm: int = NUM_PERM,
    threshold: float | None = None,
    b: int | None = None,
    r: int | None = None,
    n: int = NGRAM,
    verify: bool = False,
    scope_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy_floor: int | None = None,
) -> DataFrame:
    """``(id_col, cluster)`` of every document that has a duplicate.

    Sharing a bucket decides, as in the usual tool.  Without ``verify``, a ``threshold``
    sets the bands and rows (``bands_for``) and cannot be given together with them; the
    default is 14 bands of 8.  ``verify=True`` demands that the exact Jaccard similarity of
    bucket members reaches ``threshold`` (0.75 by default).  One edge per member joins
    what all pairs of a bucket would, so chains of neighbours would add nothing.
    ``scope_col`` keeps clusters within one value of a column (a file, say); the default
    is the whole corpus.  Rows that share an id are one document.
    """
    require_columns(df, id_col, text_col, *([scope_col] if scope_col else []))
    if (b is None) != (r is None):
        raise ValueError("give both b and r, or neither")
    if threshold is not None and not verify:
        if b is not None:
            raise ValueError("without verify, give either a threshold or b and r")
        b, r = bands_for(threshold, num_perm)
    if b is None:
        b, r = BANDS, ROWS
    _check_bands(num_perm, b, r)
    banded, edges = _same_signature(df, num_perm, b, r, n, id_col, text_col, scope_col, heavy_floor)
    if not verify:
        near = _stars(banded, "id", heavy_floor)
    else:
        # only documents that share a bucket are shingled again
        crowded = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("w")).where("w > 1")
        met = durable(
            lookup_join(banded, durable(crowded, "crowded"), ["band", "key"], "w", heavy_floor=heavy_floor), "met"
        )
        ids = met.select(F.col("id").alias(id_col)).distinct()
        sets = durable(shingles(df.join(ids, id_col, "left_semi"), n, id_col, text_col), "shingles")
        near = _verified(met, sets, id_col, THRESHOLD if threshold is None else threshold, heavy_floor)
    all_edges = edges if near is None else edges.unionByName(near)
    return components(all_edges, heavy_floor=heavy_floor).withColumnRenamed("id", id_col)


def minhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` without the documents that are not the smallest id of their cluster."""
    clusters = duplicate_clusters(df, id_col=id_col, text_col=text_col, **options)
    losers = durable(clusters.where(F.col(id_col) != F.col("cluster")).select(id_col), "losers")
    return df.join(losers, id_col, "left_anti")
