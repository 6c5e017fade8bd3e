"""Near-duplicate embeddings by randomly rotated binary codes (RaBitQ, Gao and Long, 2024).

A unit vector is rotated at random and kept as the signs of its coordinates, with one
correction factor: the inner product of the rotated vector and its signs.  Dividing by the
factor makes the inner product of a code and another rotated vector an unbiased estimate
of the cosine, whose error bound is known; pairs whose bound stays below the threshold are
refused, all others are computed again exactly, in double precision.

Pairs to estimate come from tables that deal the vectors of a label by a few code bits.
The number of bits follows the logarithm of the label's size and the number of tables
follows from the bits, so that a pair at the threshold is missed with probability MISS.
Equal vectors are folded first.  Large buckets are compared block by block; codes travel
to the blocks, and the vectors themselves only to those where a pair is left undecided.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from textloom.llm.batches import field, flat, map_batches, whole_groups
from textloom.llm.shingles import mix
from textloom.operators.components import components
from textloom.plans import durable, with_row_index
from textloom.plans.skew import lookup_join

COSINE = 0.93
BUCKET = 64          # vectors in a bucket, about
MOST_BITS = 24       # of a table's key
MISS = 1e-4          # chance that no table holds a pair at the threshold
BLOCK = 512          # vectors of a bucket that meet as many others in one task
DEVIATIONS = 5.0     # of the estimate's error that a refused pair is below the threshold
ROUNDING = 0.005     # for the bytes in which a rotated vector travels
POOL = 256           # code bits that the tables draw from, at least
SMALL = 16           # vectors of fewer coordinates are not refused by estimates

_SEED = 930


def _rotations(size: int) -> np.ndarray:
    """Enough random orthogonal matrices for the pool, side by side."""
    rng = np.random.default_rng((_SEED, size))
    parts = []
    for _ in range(max(1, -(-POOL // size))):
        q, r = np.linalg.qr(rng.standard_normal((size, size)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts, axis=1)


def tables_for(bits: int, cosine: float) -> int:
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return 1 if agree >= 1 else math.ceil(math.log(MISS) / math.log(1 - agree))


def _chosen(table: int, pool: int) -> np.ndarray:
    """The code bits that a table's key is made of, the first ``bits`` of them."""
    return np.random.default_rng((_SEED, 1, table)).permutation(pool)[:MOST_BITS]


def _keys(signs: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """One key per row and table."""
    out = np.zeros((len(signs), tables), np.int64)
    place = np.int64(1) << np.arange(bits, dtype=np.int64)
    for t in range(tables):
        out[:, t] = signs[:, _chosen(t, signs.shape[1])[:bits]].astype(np.int64) @ place
    return out


def _vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(id, label, lab, size, vector)``; ``vector`` is null where a row links with nothing."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        out: list[bytes | None] = [None] * batch.num_rows
        sizes = np.zeros(batch.num_rows, np.int32)
        values = lists.values.cast(pa.float64())
        good = np.isfinite(pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False))
        data, at = pc.fill_null(values, 0.0).to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        has = np.concatenate([[0], np.cumsum(good)])
        some = np.concatenate([[0], np.cumsum(good & (data != 0))])
        usable = (
            lists.is_valid().to_numpy(zero_copy_only=False) & batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            & (has[at[1:]] - has[at[:-1]] == np.diff(at)) & (some[at[1:]] > some[at[:-1]])
        )
        for i in np.flatnonzero(usable):
            out[i] = (data[at[i]:at[i + 1]] + 0.0).tobytes()
            sizes[i] = at[i + 1] - at[i]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes), pa.array(out, pa.binary())], ["id", "label", "size", "vector"]
        )

    rows = df.select(*[F.col(f"`{c}`").alias(n) for n, c in (("id", id_col), ("label", label_col), ("v", vector_col))])
    found = map_batches(rows, run, [
        field(df, id_col, "id"), field(df, label_col, "label"), T.StructField("size", T.IntegerType()),
        T.StructField("vector", T.BinaryType()),
    ])
    return found.withColumn("lab", F.xxhash64("label", "size"))


def _units(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares of very large numbers overflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _codes(classes: DataFrame) -> DataFrame:
    """``(c, lab, copies, size, signs, rotated, scale, factor)`` of every class."""
    made: dict[int, np.ndarray] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = batch.column(3).to_numpy()
        signs, rotated = [None] * len(size), [None] * len(size)
        scale, factor = np.zeros(len(size), np.float32), np.zeros(len(size), np.float32)
        raw = batch.column(4)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            if d not in made:
                made[d] = _rotations(int(d))
            units = _units(np.frombuffer(b"".join(raw[int(i)].as_py() for i in at), np.float64).reshape(-1, d))
            turned = units @ made[d]
            first = turned[:, :d]
            scale[at] = np.abs(first).max(axis=1) / 127
            factor[at] = np.abs(first).sum(axis=1) / math.sqrt(d)
            small = np.rint(first / scale[at][:, None].astype(np.float64)).astype(np.int8)
            packed = np.packbits(turned >= 0, axis=1)
            for k, i in enumerate(at):
                signs[i], rotated[i] = packed[k].tobytes(), small[k].tobytes()
        return pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in range(4)), pa.array(signs, pa.binary()), pa.array(rotated, pa.binary()),
             pa.array(scale), pa.array(factor)],
            ["c", "lab", "copies", "size", "signs", "rotated", "scale", "factor"],
        )

    rows = classes.select("c", "lab", "copies", "size", "vector")
    schema = [rows.schema[c] for c in ("c", "lab", "copies", "size")]
    return map_batches(rows, run, [
        *schema, T.StructField("signs", T.BinaryType()), T.StructField("rotated", T.BinaryType()),
        T.StructField("scale", T.FloatType()), T.StructField("factor", T.FloatType()),
    ])


def _signs(column: pa.Array, size: int) -> np.ndarray:
    width = size * max(1, -(-POOL // size))
    return np.unpackbits(flat(column)[0].reshape(len(column), -1), axis=1)[:, :width]


def _buckets(codes: DataFrame, cosine: float) -> DataFrame:
    """``(g, t, c)``: the bucket of every class in every table of its label."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lab, size, bits = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(4).to_numpy()
        g, t, c = [], [], []
        for d, b in sorted(set(zip(size.tolist(), bits.tolist()))):
            at = np.flatnonzero((size == d) & (bits == b))
            tables = tables_for(b, cosine)
            keys = _keys(_signs(pc.take(batch.column(3), pa.array(at)), d), tables, b)
            table = np.arange(tables)
            mixed = mix(mix(lab[at].astype(np.uint64)[:, None] + table.astype(np.uint64)) + keys.astype(np.uint64))
            g.append(mixed.view(np.int64).ravel())
            t.append(np.tile(table, len(at)).astype(np.int32))
            c.append(np.repeat(batch.column(0).to_numpy()[at], tables))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (g, t, c)], ["g", "t", "c"])

    return map_batches(codes.select("c", "lab", "size", "signs", "bits"), run, [
        T.StructField("g", T.LongType()), T.StructField("t", T.IntegerType()), T.StructField("c", T.LongType()),
    ])


def _undecided(rows: pa.RecordBatch, lo: int, hi: int, cosine: float):
    """``(x, y)``: pairs of a block that estimates do not refuse and that no earlier table holds."""
    def column(name):
        return rows.column(rows.schema.get_field_index(name)).slice(lo, hi - lo)

    side, lab = column("side").to_numpy(), column("lab").to_numpy()
    bits, size, t = column("bits").to_numpy(), column("size").to_numpy(), int(column("t")[0].as_py())
    scale, factor = column("scale").to_numpy(), column("factor").to_numpy()
    within = rows.column(1)[lo].as_py() == rows.column(2)[lo].as_py()
    for label in np.unique(lab):
        own = np.flatnonzero(lab == label)
        left = own if within else own[side[own] == 0]
        right = own if within else own[side[own] == 1]
        if not len(left) or not len(right):
            continue
        d = int(size[own[0]])
        pool = _signs(pc.take(column("signs"), pa.array(own)), d)
        back = np.zeros(hi - lo, np.int64)
        back[own] = np.arange(len(own))
        if d < SMALL:
            ok = np.ones((len(left), len(right)), bool)
        else:
            turned = flat(pc.take(column("rotated"), pa.array(left)))[0].view(np.int8).reshape(len(left), d)
            codes = pool[back[right], :d].astype(np.float32) * 2 - 1
            estimate = (turned.astype(np.float32) * scale[left][:, None]) @ codes.T / (math.sqrt(d) * factor[right])
            f2 = np.minimum(factor[right].astype(np.float64) ** 2, 1.0)
            error = DEVIATIONS * math.sqrt(1 - cosine * cosine) * np.sqrt((1 - f2) / f2) / math.sqrt(d - 1)
            ok = estimate >= cosine - error - ROUNDING
        if within:
            ok &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
        x, y = np.nonzero(ok)
        x, y = left[x], right[y]
        if t and len(x):
            keys = _keys(pool, t, int(bits[own[0]]))
            new = np.ones(len(x), bool)
            for k in range(t):
                new &= keys[back[x], k] != keys[back[y], k]
            x, y = x[new], y[new]
        if len(x):
            yield x, y


def _open_rows(blocks: DataFrame, cosine: float) -> DataFrame:
    """The rows of each block that take part in an undecided pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, ends in whole_groups(batches, 3):
            keep = np.zeros(rows.num_rows, bool)
            for lo, hi in zip(starts, ends):
                for x, y in _undecided(rows, lo, hi, cosine):
                    keep[lo + x] = keep[lo + y] = True
            if keep.any():
                yield rows.filter(pa.array(keep))

    return blocks.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(run, blocks.schema)


def _exact(open_rows: DataFrame, vectors: DataFrame, cosine: float) -> DataFrame:
    """``(a, b, links)`` from exact cosines: with ``b`` null, how many vectors a block links to
    class ``a``; else a link, of those of a block as many as join what they join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts, ends in whole_groups(batches, 3):
            names = rows.schema.names
            c = rows.column(names.index("c")).to_numpy()
            copies = rows.column(names.index("copies")).to_numpy()
            raw = rows.column(names.index("vector"))
            a, b, links = [], [], []
            for lo, hi in zip(starts, ends):
                count = np.zeros(hi - lo, np.int64)
                root: dict[int, int] = {}
                for x, y in _undecided(rows, lo, hi, cosine):
                    used, place = np.unique(np.concatenate([x, y]), return_inverse=True)
                    units = _units(np.frombuffer(
                        b"".join(raw[int(lo + k)].as_py() for k in used), np.float64
                    ).reshape(len(used), -1))
                    xs, ys = place[:len(x)], place[len(x):]
                    left, right = np.unique(xs), np.unique(ys)
                    table = units[left] @ units[right].T
                    linked = table[np.searchsorted(left, xs), np.searchsorted(right, ys)] >= cosine
                    x, y = x[linked], y[linked]
                    np.add.at(count, x, copies[lo + y])
                    np.add.at(count, y, copies[lo + x])
                    for p, q in zip(x.tolist(), y.tolist()):
                        while p in root:
                            p = root[p]
                        while q in root:
                            q = root[q]
                        if p != q:
                            root[max(p, q)] = min(p, q)
                            a.append(c[lo + p])
                            b.append(c[lo + q])
                            links.append(0)
                for k in np.flatnonzero(count):
                    a.append(c[lo + k])
                    b.append(None)
                    links.append(count[k])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"]
                )

    rows = open_rows.join(vectors, "c").select(*open_rows.columns, "vector")
    long = T.LongType()
    return rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j").mapInArrow(
        run, T.StructType([T.StructField(n, long) for n in ("a", "b", "links")])
    )


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE,
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row of ``df``.

    Vectors are compared when their labels are equal and not null and they have as many
    coordinates.  ``n_links`` counts the other rows with a cosine of at least ``cosine``;
    ``component_id`` is the smallest id reachable by links, ``kept`` whether it is the
    row's own.  Null, empty and zero vectors and those with a null or non-finite coordinate
    link with nothing.  Rows of one id are told apart by their vectors and linked like
    others.  Rows without an id count as links; a component of such rows alone has a null
    id and stays whole.  Other columns are ignored; an empty table gives an empty one.
    """
    rows = durable(_vectors(df, id_col, vector_col, label_col), "vectors")
    full = rows.where("vector is not null")
    folded = full.groupBy("lab", "size", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = durable(
        with_row_index(folded, F.asc_nulls_last("rep"), F.col("lab"), F.col("vector"), name="c"), "vector-classes"
    )
    sizes = classes.groupBy("lab").agg(F.count(F.lit(1)).alias("w"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("w") / F.lit(float(BUCKET)))), F.lit(0)), F.lit(MOST_BITS)).cast("int")
    sizes = sizes.withColumn("bits", bits)
    codes = durable(lookup_join(durable(_codes(classes), "codes"), sizes, ["lab"], "w"), "codes-by-label")
    found = durable(_buckets(codes, cosine), "buckets")
    counts = found.groupBy("g").agg(F.count(F.lit(1)).alias("w")).where("w > 1")
    parts = counts.withColumn("parts", F.ceil(F.col("w") / BLOCK).cast("int"))
    placed = lookup_join(found, parts, ["g"], "w").withColumn("at", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
    blocks = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "g", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"),
        (F.col("at") > F.col("other")).cast("int").alias("side"), "t", "c",
    ).join(codes, "c")
    blocks = blocks.select(
        "g", "i", "j", "side", "t", "c", "lab", "copies", "size", "bits", "signs", "rotated", "scale", "factor"
    )
    open_rows = durable(_open_rows(blocks, cosine), "open-vectors")
    exact = durable(_exact(open_rows, classes.select("c", "vector"), cosine), "exact-links")
    joined = components(exact.where("b is not null").select("a", "b")).select(F.col("id").alias("c"), "cluster")
    links = exact.where("b is null").groupBy(F.col("a").alias("c")).agg(F.sum("links").alias("links"))
    named = classes.select("c", "lab", "size", "vector", "copies", "rep").join(joined, "c", "left").join(links, "c", "left")
    head = classes.select(F.col("c").alias("cluster"), F.col("rep").alias("head"))
    groups = _with_heads(named.withColumn("cluster", F.coalesce("cluster", "c")), head)
    out = rows.join(groups, ["lab", "size", "vector"], "left")
    component = F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("head"))
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("links"), F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _with_heads(named: DataFrame, head: DataFrame) -> DataFrame:
    """Classes with the id that leads their component and the links of each of their rows."""
    members = named.groupBy("cluster").agg(F.count(F.lit(1)).alias("w"))
    heads = durable(members.join(head, "cluster"), "component-heads")
    return lookup_join(named, heads, ["cluster"], "w").select(
        "lab", "size", "vector", "copies", "head", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
