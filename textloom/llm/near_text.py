"""Near-duplicate texts by MinHash: banding, signature checks, exact sets, components.

Texts with equal sets are folded into classes first, so a group of copies of any size is
one vertex; ids are joined to classes at the end, as one id may hold texts of several.  A class's signature is cut into bands; classes that share a band are
candidates.  They are linked without listing all pairs of a band:

1. every class is compared with one centre, the class around which most of its bands
   crowd (the least changed copy of a group), and components are formed;
2. only pairs of one band that are still in different components remain.  They are
   compared block by block, first by signature, then, where the signatures leave it
   open, by their full sets.

Every link is confirmed on the full sets.  A pair at the threshold is missed by all bands
with probability 2.4e-5, and refused by its signature with 3e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from textloom.llm.batches import field, flat, map_batches, narrow, whole_groups
from textloom.llm.shingles import WIDTH, mix, sets_by_slice
from textloom.operators.components import components
from textloom.plans import durable, with_row_index
from textloom.plans.skew import lookup_join

THRESHOLD = Fraction(3, 4)
BANDS, ROWS = 28, 4
HASHES = BANDS * ROWS
SLACK = 4.0                   # standard deviations below the threshold at which a signature refuses a pair
BLOCK = 256                   # members of a band that are compared with as many others in one task
DEALT = 64                    # members that one task compares with a common centre
BROADCAST_IDS = 1_000_000     # ids that are broadcast at most (8 MB); more are joined by shuffle

_RANDOM = np.random.default_rng(75)
_FACTORS = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _signatures(column: pa.Array, width: int) -> tuple[np.ndarray, list[bytes | None], np.ndarray]:
    """Set sizes, digests of the sets, and signatures of a batch of texts."""
    data, at = flat(column)
    n = len(at) - 1
    sizes, digests = np.zeros(n, np.int64), [None] * n
    signatures = np.zeros((n, HASHES), np.uint32)
    for i, j, shingles, bounds in sets_by_slice(data, at, width):
        lo, hi = bounds[:-1], bounds[1:]
        sizes[i:j] = hi - lo
        full = np.flatnonzero(hi > lo)
        if not len(full):
            continue
        pair = np.stack([
            np.add.reduceat(mix(shingles ^ np.uint64(salt)), lo[full]) for salt in (0x5851F42D, 0x14057B7E)
        ], axis=1)
        for k, row in enumerate(full):
            digests[i + row] = pair[k].tobytes()
        x = shingles >> np.uint64(32)
        for h in range(HASHES):
            least = np.minimum.reduceat(x * _FACTORS[h] + _SHIFTS[h], lo[full])
            signatures[i + full, h] = least >> np.uint64(32)
    return sizes, digests, signatures


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """``(id, text_hash, n, digest, signature)``; digest and signature are null for an empty set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, found = _signatures(batch.column(1), width)
        rows = [found[k].tobytes() if sizes[k] else None for k in range(len(sizes))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes), pa.array(digests, pa.binary()), pa.array(rows, pa.binary())],
            ["id", "text_hash", "n", "digest", "signature"],
        )

    return map_batches(_hashed(docs, id_col, text_col), run, [
        field(docs, id_col, "id"), T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
        T.StructField("signature", T.BinaryType()),
    ])


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return narrow(docs, id=id_col, text=text_col).withColumn("text_hash", F.xxhash64("text"))


def _matrix(column: pa.Array) -> np.ndarray:
    return flat(column)[0].view(np.uint32).reshape(-1, HASHES)


def _band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    keys = np.zeros((len(found), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(found), b + 1, np.uint64)
        for c in range(b * ROWS, b * ROWS + ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + found[:, c])
        keys[:, b] = key
    return keys


def _bands(reps: DataFrame) -> DataFrame:
    """``(key, id)``: the bands of every class."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = _band_keys(_matrix(batch.column(1)))
        ids = pc.take(batch.column(0), pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), ids], ["key", "id"])

    return map_batches(reps.select("id", "signature"), run, [T.StructField("key", T.LongType()), field(reps, "id")])


def _by_id(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among ``ids``; these are broadcast only up to a limit."""
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, on, "left_semi")


def _confirmed(texts: DataFrame, pairs: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough.

    ``pairs`` holds ``(a, b, g, s)``; the texts of a group ``(g, s)`` meet in one task, each
    once, and its pairs follow.  Groups have a bounded number of members.
    """
    needs = pairs.select("g", "s", F.explode(F.array("a", "b")).alias("id")).distinct()
    kind = pairs.schema["a"].dataType
    none = F.lit(None)
    rows = needs.join(texts, "id").select("g", "s", F.lit(0).alias("k"), F.col("id").alias("a"), none.cast(kind).alias("b"), "text")
    rows = rows.unionByName(pairs.select("g", "s", F.lit(1).alias("k"), "a", "b", none.cast("string").alias("text")))
    top, bottom = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, {}
        for batch in batches:
            kinds = batch.column(2).to_numpy()
            groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            a, b = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            data, at = flat(batch.column(5))
            sets = sets_by_slice(data, at, width)
            lo = hi = 0
            linked = []
            for r in range(batch.num_rows):
                if r >= hi:
                    lo, hi, shingles, bounds = next(sets)
                if groups[r] != group:
                    group, held = groups[r], {}
                if kinds[r] == 0:
                    held[a[r]] = shingles[bounds[r - lo]:bounds[r - lo + 1]].copy()
                elif _similar(held[a[r]], held[b[r]], top, bottom):
                    linked.append(r)
            if linked:
                keep = pa.array(linked)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column(3), keep), pc.take(batch.column(4), keep)], ["a", "b"]
                )

    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    return rows.repartition("g", "s").sortWithinPartitions("g", "s", "k").mapInArrow(run, schema)


def _similar(x: np.ndarray, y: np.ndarray, top: int, bottom: int) -> bool:
    """Whether two sorted sets reach the threshold, in whole numbers."""
    if len(y) < len(x):
        x, y = y, x
    if bottom * len(x) < top * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return bottom * both >= top * (len(x) + len(y) - both)


def _star_pairs(members: DataFrame) -> DataFrame:
    """``(a, b, g, s)``: every class and the centre that it shares most bands with."""
    crowd = members.groupBy("id").agg(F.sum("size").alias("crowd"))
    centres = (
        members.join(crowd, "id").groupBy("key", "size")
        .agg(F.min(F.struct((-F.col("crowd")).alias("c"), F.col("id").alias("b")))["b"].alias("b"))
    )
    joined = lookup_join(members.drop("size"), centres, ["key"], "size")
    best = (
        joined.where("id <> b").groupBy("id", "b").agg(F.count(F.lit(1)).alias("shared"))
        .groupBy("id").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    )
    return best.select(F.col("id").alias("a"), "b")


def _dealt(pairs: DataFrame) -> DataFrame:
    """Deal the partners of a centre over tasks of at most about ``DEALT`` members."""
    load = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("w"), F.ceil(F.count(F.lit(1)) / DEALT).alias("parts"))
    return lookup_join(pairs, load, ["b"], "w").select(
        "a", "b", F.col("b").cast("string").alias("g"), F.pmod(F.xxhash64("a"), F.col("parts")).cast("long").alias("s")
    )


def _open_blocks(members: DataFrame, reps: DataFrame, found: DataFrame) -> DataFrame:
    """``(key, s, t, left, id, cluster, n, signature)``: what is still to be compared.

    In a band whose members lie in several components, the members outside its largest
    component meet that component and each other, in blocks; the largest component is not
    compared with itself.
    """
    placed = members.join(found.withColumnRenamed("cluster", "c"), "id", "left").select(
        "key", "id", F.coalesce("c", "id").alias("cluster")
    )
    sizes = placed.groupBy("key", "cluster").agg(F.count(F.lit(1)).alias("w"))
    mains = sizes.groupBy("key").agg(
        F.max_by("cluster", F.struct("w", "cluster")).alias("main"), F.max("w").alias("mw"), F.sum("w").alias("all"),
        F.count(F.lit(1)).alias("parts"),
    ).where("parts > 1").drop("parts")
    rows = lookup_join(placed, mains.withColumn("w", F.col("all")), ["key"], "w")
    rows = rows.join(reps, "id")
    blocks = F.ceil((F.col("all") - F.col("mw")) / BLOCK).cast("int")
    main_blocks = F.ceil(F.col("mw") / BLOCK).cast("int")
    stray = F.col("cluster") != F.col("main")
    rows = rows.withColumn("s_n", blocks).withColumn("m_n", main_blocks).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.when(stray, F.col("s_n")).otherwise(F.col("m_n"))).cast("int")
    )
    cols = ["key", "s", "t", "left", "id", "cluster", "n", "signature"]
    left = rows.where(stray).withColumn("s", F.col("block")).withColumn("left", F.lit(True)).withColumn(
        "t", F.explode(F.sequence(F.lit(0), F.col("m_n") + F.col("s_n") - 1))
    )
    right = rows.withColumn("left", F.lit(False)).withColumn(
        "s", F.explode(F.sequence(F.lit(0), F.when(stray, F.col("block")).otherwise(F.col("s_n") - 1)))
    ).withColumn("t", F.when(stray, F.col("m_n") + F.col("block")).otherwise(F.col("block")))
    return left.select(cols).unionByName(right.select(cols))


def _open_in(found: np.ndarray, keys: np.ndarray, key: int, left, clusters, n, threshold: Fraction):
    """``(i, j)`` of a block: pairs of different components that their signatures and set
    sizes do not rule out.  A pair that shares several bands is met in the first of them only."""
    p = float(threshold)
    least = int(np.floor(HASHES * (p - SLACK * np.sqrt(p * (1 - p) / HASHES))))
    rows, cols = np.flatnonzero(left), np.flatnonzero(~left)
    if len(rows) * len(cols) <= 256:
        same = (found[rows][:, None, :] == found[cols][None, :, :]).sum(axis=2)
    else:
        same = np.zeros((len(rows), len(cols)), np.uint8)
        for h in range(HASHES):
            same += found[rows, h][:, None] == found[cols, h][None, :]
    ok = (same >= least) & (clusters[rows][:, None] != clusters[cols][None, :])
    i, j = np.nonzero(ok)
    a, b = n[rows[i]], n[cols[j]]
    fit = threshold.denominator * np.minimum(a, b) >= threshold.numerator * np.maximum(a, b)
    i, j = rows[i[fit]], cols[j[fit]]
    if not len(i):
        return i, j
    first = (keys[i] == keys[j]).argmax(axis=1)
    here = keys[i, first].view(np.int64) == key
    return i[here], j[here]


def _open_rows(blocks: DataFrame, threshold: Fraction) -> DataFrame:
    """The rows of each block that take part in a pair which only full sets can decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, ends in whole_groups(batches, 3):
            key, left = rows.column(0).to_numpy(), rows.column(3).to_numpy(zero_copy_only=False)
            clusters = np.array(rows.column(5).to_pylist(), object)
            n, found = rows.column(6).to_numpy(), _matrix(rows.column(7))
            keys = _band_keys(found)
            open_ = np.zeros(rows.num_rows, bool)
            for lo, hi in zip(starts, ends):
                if left[lo:hi].any():
                    i, j = _open_in(found[lo:hi], keys[lo:hi], key[lo], left[lo:hi], clusters[lo:hi], n[lo:hi], threshold)
                    open_[lo + i] = open_[lo + j] = True
            if open_.any():
                yield rows.filter(pa.array(open_))

    return blocks.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t").mapInArrow(run, blocks.schema)


def _block_links(open_rows: DataFrame, texts: DataFrame, width: int, threshold: Fraction) -> DataFrame:
    """``(a, b)``: links between components, confirmed on full sets; of the links of one block
    as many as it takes to join what they join."""
    kind = open_rows.schema["id"].dataType
    top, bottom = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, ends in whole_groups(batches, 3):
            key, left = rows.column(0).to_numpy(), rows.column(3).to_numpy(zero_copy_only=False)
            ids, clusters = rows.column(4).to_pylist(), np.array(rows.column(5).to_pylist(), object)
            n, found = rows.column(6).to_numpy(), _matrix(rows.column(7))
            keys = _band_keys(found)
            data, at = flat(rows.column(8))
            a, b = [], []
            for lo, hi in zip(starts, ends):
                i, j = _open_in(found[lo:hi], keys[lo:hi], key[lo], left[lo:hi], clusters[lo:hi], n[lo:hi], threshold)
                if not len(i):
                    continue
                sets = []
                for _, _, shingles, bounds in sets_by_slice(data, at[lo:hi + 1], width):
                    sets += np.split(shingles, bounds[1:-1])
                root: dict = {}

                def top_of(c):
                    while root.get(c, c) != c:
                        c = root[c]
                    return c

                for x, y in zip(i, j):
                    p, q = top_of(clusters[lo + x]), top_of(clusters[lo + y])
                    if p != q and _similar(sets[x], sets[y], top, bottom):
                        root[p] = q
                        a.append(ids[lo + x])
                        b.append(ids[lo + y])
            if a:
                kept = rows.column(4).type
                yield pa.RecordBatch.from_arrays([pa.array(a, kept), pa.array(b, kept)], ["a", "b"])

    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    rows = open_rows.join(texts, "id").select(*open_rows.columns, "text")
    return rows.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t").mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links, ``kept`` is whether it is the
    row's own.  Null texts and texts without words have an empty set and are linked with
    nothing.  Rows that share an id are one document, with the links of all their texts: they
    lie in one component.  Rows without an id are linked with nothing; their component is
    null and they are kept.
    Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    signed = durable(signatures(docs, id_col, text_col, width), "signatures")
    full = signed.where("digest is not null and id is not null")
    grouped = full.groupBy("n", "digest").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.count(F.lit(1)).alias("rows"))
    # a class is a vertex under a number of its own; its first row's text stands for it
    classes = durable(
        with_row_index(grouped, "n", "digest", name="class").select("class", "n", "digest", "rows", "first.id", "first.text_hash"),
        "classes",
    )
    first = ["n", "digest", "id", "text_hash"]
    reps = durable(
        full.join(classes.select("class", *first), first).select(F.col("class").alias("id"), "n", "signature").dropDuplicates(["id"]),
        "class-signatures",
    )
    bands = _bands(reps)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = durable(lookup_join(bands, shared.withColumn("w", F.col("size")), ["key"], "w"), "band-members")
    met = members.select(F.col("id").alias("class")).distinct()
    named = durable(classes.select("class", "id", "text_hash").join(met, "class", "left_semi"), "candidate-classes")
    wanted = _by_id(_hashed(docs, id_col, text_col).where("id is not null"), named.select("id").distinct(), "id")
    texts = durable(
        wanted.join(named, ["id", "text_hash"]).select(F.col("class").alias("id"), "text").dropDuplicates(["id"]), "candidate-texts"
    )
    links = durable(_confirmed(texts, _dealt(durable(_star_pairs(members), "star-pairs")), width, threshold), "star-links")
    near = durable(components(links), "star-components")
    open_rows = durable(_open_rows(_open_blocks(members, reps, near), threshold), "open-rows")
    more = durable(_block_links(open_rows, texts, width, threshold), "more-links")
    # classes of one id hang on the smallest of them
    keyed = classes.select("class", "n", "digest", F.col("rows").alias("w"))
    held = durable(
        lookup_join(full.select("id", "n", "digest"), keyed, ["n", "digest"], "w").select("id", "class").distinct(), "ids-classes"
    )
    several = held.groupBy("id").agg(F.min("class").alias("b"), F.count(F.lit(1)).alias("w")).where("w > 1")
    joined = lookup_join(held, durable(several, "ids-of-classes"), ["id"], "w").select(F.col("class").alias("a"), "b").where("a <> b")
    found = components(links.unionByName(more).unionByName(joined)).withColumnRenamed("id", "class")
    placed = durable(classes.join(found, "class", "left").withColumn("cluster", F.coalesce("cluster", "class")), "components")
    least = placed.groupBy("cluster").agg(F.min("id").alias("c"), F.count(F.lit(1)).alias("w"))
    classed = durable(
        lookup_join(placed.select("n", "digest", "rows", "cluster"), least, ["cluster"], "w").select("n", "digest", "c", F.col("rows").alias("w")),
        "components",
    )
    rows = signed.select("id", "n", "digest")
    out = lookup_join(rows.where("digest is not null"), classed, ["n", "digest"], "w", "left").select("id", "n", "c")
    out = out.unionByName(rows.where("digest is null").select("id", "n", F.lit(None).cast(out.schema["c"].dataType).alias("c")))
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group.  Of rows that share an id one stays, the first
    by its text's hash; rows without an id all stay."""
    ids = found.where(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept")
    )
    lost = durable(ids.where(~F.col("kept")).select("id"), "near-duplicates")
    again = durable(ids.where("kept and rows > 1").select("id"), "repeated-ids")
    few = [x.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS for x in (lost, again)]
    lost, again = (F.broadcast(x) if small else x for x, small in zip((lost, again), few))
    rows = docs.join(lost, docs[f"`{id_col}`"] == lost["id"], "left_anti")
    if again.isEmpty():
        return rows
    single = rows.join(again, rows[f"`{id_col}`"] == again["id"], "left_anti")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    several = rows.join(again, rows[f"`{id_col}`"] == again["id"], "left_semi").select(
        whole, F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h")
    ).withColumn("place", F.expr("row_number() OVER (PARTITION BY id ORDER BY h)"))
    return single.unionByName(several.where("place = 1").select("row.*"))
