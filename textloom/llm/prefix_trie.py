"""The trie of shared conversation prefixes, by vertical bitmaps.

Conversations are numbered in the order of their ids and dealt in shards of ``WIDTH``
neighbours.  A shard holds, for every (position, turn), the set of its conversations
with that turn there, as a bitset.  A node is the bitset of the conversations that begin
with its turns; going down, its children are the intersections with the postings of the
next position, their sizes are popcounts, and the conversations that end at it are the
intersection with those of that length.  Shards are joined by a fingerprint of the
prefix, the exclusive or of two 64-bit hashes of every (position, turn) in it.

Nothing grows with one conversation: positions come from a global row index, and a
shard takes ``SLAB`` positions at a time, entered by the prefixes so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.plans import discard, durable, lookup_join, with_row_index

WIDTH = 512     # conversations in a shard: bits in a bitset
SLAB = 64       # positions that a shard takes at a time
BLOCK = 1024    # nodes of one conversation whose sums are added up in one window
ENTER, TURN, END = 0, 1, 2
LEND = 9        # fixed value: conversations take over crc32 % 9 turns
GROUP = 5       # fixed value: from the first of five neighbouring ids

_FOUND = (
    "depth bigint, k1 bigint, k2 bigint, u1 bigint, u2 bigint, n bigint, conv bigint, n_bytes bigint, ends array<bigint>"
)


@dataclass(frozen=True)
class PrefixTrie:
    """``nodes``: ``(k1, k2, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens)``; ``ends``: ``(k1, k2, first, ids)``, one row for each node and shard with
    the ascending ids of the conversations that end there, ``first`` being the smallest."""

    nodes: DataFrame
    ends: DataFrame


def turns_of(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, turn, digest, n_bytes)``: 16 bytes instead of every role and text."""
    role, text = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return df.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.md5(whole.cast("binary"))).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
    ).where("conv is not null")


def lent_turns(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes over."""
    return F.crc32(conv.cast("string").cast("binary")) % LEND


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(convs, rows)`` of the rebuilt conversations: ``(conv, shard, bit, length)`` and
    ``(conv, shard, bit, length, pos, digest, n_bytes)``."""
    index = with_row_index(turns, "conv", F.col("turn").asc_nulls_first(), "digest").drop("turn")
    base = F.col("conv") - F.col("conv") % GROUP
    counted = index.groupBy("conv").agg(F.min("row_idx").alias("start"), F.count(F.lit(1)).alias("n"))
    counted = durable(counted.withColumns({"h": lent_turns(F.col("conv")), "base": base}), "conversations")
    bases = counted.where("conv = base").select("base", F.col("n").alias("base_n"))
    lent = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = counted.join(bases, "base", "left").withColumns({
        "lent": lent, "length": lent + F.greatest(F.col("n") - F.col("h"), F.lit(0)),
    })
    numbered = with_row_index(convs.drop("base_n"), "conv", name="number")
    convs = durable(
        numbered.withColumns({"shard": F.floor(F.col("number") / WIDTH), "bit": F.col("number") % WIDTH}), "conversations"
    )
    own = convs.select("conv", "start", "h", "lent", "length", "shard", "bit", F.col("n").alias("w"))
    placed = durable(
        lookup_join(index, own, ["conv"], "w").withColumn("p", F.col("row_idx") - F.col("start")).drop("row_idx", "start"), "placed"
    )
    kept = placed.where("p >= h").withColumn("pos", F.col("lent") + F.col("p") - F.col("h"))
    takers = convs.where("lent > 0").select("base", "conv", "shard", "bit", "lent", "length")
    given = placed.where(f"conv % {GROUP} = 0 and p < {LEND - 1}").select(F.col("conv").alias("base"), F.col("p").alias("pos"), "digest", "n_bytes")
    taken = given.join(takers, "base").where("pos < lent")  # at most 8 turns to 9 conversations
    columns = ["conv", "shard", "bit", "length", "pos", "digest", "n_bytes"]
    return convs.select("conv", "shard", "bit", "length"), kept.select(columns).unionByName(taken.select(columns))


def _slabs(convs: DataFrame, rows: DataFrame, slab: int) -> DataFrame:
    """All that a shard needs for a slab: the turns, where conversations end, and the fingerprint
    with which each one enters."""
    turns = durable(
        rows.select(
            "shard", F.floor(F.col("pos") / slab).alias("slab"), F.lit(TURN).alias("kind"), "pos", "bit", "conv", "length",
            F.xxhash64("pos", "digest").alias("p1"), F.xxhash64("digest", F.lit(1), "pos").alias("p2"), "n_bytes",
        ), "turns",
    )
    none = F.lit(0).cast("long")
    head = ["shard", "bit", "conv"]
    last = F.floor(F.col("length") / slab)
    ends = convs.select(*head, last.alias("slab"), F.lit(END).alias("kind"), F.col("length").alias("pos"), none.alias("p1"), none.alias("p2"))
    starts = convs.select(*head, F.lit(0).cast("long").alias("slab"), F.lit(ENTER).alias("kind"), none.alias("pos"), none.alias("p1"), none.alias("p2"))
    # only conversations of more than one slab
    parts = turns.where(F.col("length") >= slab).groupBy(*head, "length", "slab").agg(F.bit_xor("p1").alias("p1"), F.bit_xor("p2").alias("p2"))
    so_far = Window.partitionBy("conv").orderBy("slab")
    later = parts.select(
        *head, (F.col("slab") + 1).alias("slab"), F.lit(ENTER).alias("kind"), ((F.col("slab") + 1) * slab).alias("pos"),
        F.bit_xor("p1").over(so_far).alias("p1"), F.bit_xor("p2").over(so_far).alias("p2"),
        "length",
    ).where(F.col("slab") <= F.floor(F.col("length") / slab)).drop("length")
    marks = ends.unionByName(starts).unionByName(later).withColumn("n_bytes", none)
    return turns.drop("length").unionByName(marks)


def grow(rows: pa.Table) -> pa.Table:
    """The nodes of one shard in one slab, depth first."""
    postings: dict[tuple, int] = {}       # (position, turn) -> conversations
    turn_of: dict[tuple, tuple] = {}      # (position, bit) -> turn
    going: dict[int, int] = {}            # position -> conversations with a turn there
    ending: dict[int, int] = {}           # length -> conversations
    entered: dict[tuple, int] = {}        # fingerprint -> conversations
    sizes, ids = {}, {}
    columns = [rows.column(c).to_pylist() for c in ("kind", "pos", "bit", "conv", "p1", "p2", "n_bytes")]
    for kind, pos, bit, conv, p1, p2, n_bytes in zip(*columns):
        one, turn = 1 << bit, (p1, p2)
        ids[bit] = conv
        if kind == TURN:
            postings[pos, turn] = postings.get((pos, turn), 0) | one
            turn_of[pos, bit] = turn
            going[pos] = going.get(pos, 0) | one
            sizes[turn] = n_bytes
        elif kind == END:
            ending[pos] = ending.get(pos, 0) | one
        else:
            entered[pos, turn] = entered.get((pos, turn), 0) | one

    out: list[tuple] = []

    def ends_at(members: int, depth: int) -> list[int]:
        found, rest = [], members & ending.get(depth, 0)
        while rest:
            low = rest & -rest
            found.append(ids[low.bit_length() - 1])
            rest ^= low
        return found

    def smallest(members: int) -> int:
        return ids[(members & -members).bit_length() - 1]

    open_nodes = []
    for (depth, key), members in entered.items():
        ends = ends_at(members, depth)
        if depth == 0:
            out.append((0, 0, 0, None, None, members.bit_count(), smallest(members), 0, ends))
        elif ends:  # the slab before has given the node
            out.append((depth, *key, None, None, 0, smallest(members), None, ends))
        open_nodes.append((depth, key, members))
    while open_nodes:
        depth, key, members = open_nodes.pop()
        rest = members & going.get(depth, 0)
        while rest:
            turn = turn_of[depth, (rest & -rest).bit_length() - 1]
            child = members & postings[depth, turn]
            rest &= ~child
            mark = (key[0] ^ turn[0], key[1] ^ turn[1])
            out.append((depth + 1, *mark, *key, child.bit_count(), smallest(child), sizes[turn], ends_at(child, depth + 1)))
            open_nodes.append((depth + 1, mark, child))
    kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())]
    names = [f.split()[0] for f in _FOUND.split(", ")]
    return pa.table([pa.array(list(c), k) for c, k in zip(zip(*out) if out else [[]] * 9, kinds)], names)


def _subtree_totals(chains: DataFrame) -> DataFrame:
    """``(conv, leaves, saved)``: sums over everything below a conversation's own nodes.

    A conversation owns the nodes whose smallest member it is, a run of depths that hangs
    on a node of a smaller one.  Sums go up by doubling: after k rounds they hold all that
    hangs fewer than 2^k runs below.
    """
    totals = durable(chains.select("conv", "leaves", "saved"), "totals")
    hops = durable(chains.where("up is not null").select("conv", F.col("up").alias("hop")), "hops")
    while not hops.isEmpty():
        gains = hops.join(totals, "conv").groupBy("hop").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"), F.count(F.lit(1)).alias("w")
        )
        gains = durable(gains, "gains")
        bigger = durable(
            totals.join(gains.withColumnRenamed("hop", "conv"), "conv", "left").select(
                "conv", (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ), "totals",
        )
        above = hops.select(F.col("conv").alias("hop"), F.col("hop").alias("next")).join(gains.select("hop", "w"), "hop")
        further = durable(lookup_join(hops, above, ["hop"], "w").select("conv", F.col("next").alias("hop")), "hops")
        discard(totals, hops, gains)
        totals, hops = bigger, further
    return totals


def prefix_trie(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    slab: int = SLAB,
) -> PrefixTrie:
    """The trie of the rebuilt conversations of ``df``.

    Turns stand in the order of ``turn_col``, null first; turns of one number in the order of
    the MD5 of their role and text; a repeated row is a turn of its own.  A null role or text
    counts as empty.  Rows without a conversation are left out.  Conversation c takes over the
    first crc32(c) % 9 turns of conversation c - c % 5 (the remainder has c's sign), and goes
    on with its own turns after as many.  Other columns are ignored; an empty table gives no
    node, not even a root.
    """
    convs, rows = _rebuilt(turns_of(df, conv_col, turn_col, role_col, text_col))
    found = durable(_slabs(convs, rows, slab).groupBy("shard", "slab").applyInArrow(grow, _FOUND), "shard-nodes")
    nodes = durable(
        found.groupBy("depth", "k1", "k2").agg(
            F.max("u1").alias("u1"), F.max("u2").alias("u2"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
            F.max("n_bytes").alias("n_bytes"),
        ), "nodes",
    )
    kids = nodes.where("depth > 0").groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("n_children"))
    counted = durable(
        nodes.join(kids.select(F.col("u1").alias("k1"), F.col("u2").alias("k2"), "n_children"), ["k1", "k2"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes",
    )
    parents = counted.where("n_children > 0").select(
        F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("parent"), F.col("n_children").alias("w")
    )
    tree = durable(
        lookup_join(counted.where("depth > 0"), parents, ["u1", "u2"], "w")
        .unionByName(counted.where("depth = 0").withColumn("parent", F.lit(None).cast("long")))
        .withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "own": (F.col("n") - 1) * F.col("n_bytes")}), "tree",
    )
    chains = durable(
        tree.groupBy("conv").agg(
            F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"), (F.min("depth") - 1).alias("at"),
            F.min_by("parent", "depth").alias("up"),
        ), "chains",
    )
    hung = chains.where("up is not null").select("conv", "at", "up").join(_subtree_totals(chains), "conv")
    hung = hung.groupBy(F.col("up").alias("conv"), F.col("at").alias("depth")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    valued = durable(
        tree.join(hung, ["conv", "depth"], "left").select(
            "k1", "k2", "conv", "depth", "parent", "n", "n_children", F.floor(F.col("depth") / BLOCK).alias("block"),
            (F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("own") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        ), "values",
    )
    # sums from a node down its conversation: inside a block, and over the blocks below
    blocks = valued.groupBy("conv", "block").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    below = Window.partitionBy("conv").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = blocks.select("conv", "block", F.sum("l").over(below).alias("l"), F.sum("s").over(below).alias("s")).where("l is not null")
    inside = Window.partitionBy("conv", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = valued.withColumns({"leaves": F.sum("leaves").over(inside), "saved": F.sum("saved").over(inside)})
    summed = summed.join(after, ["conv", "block"], "left")
    return PrefixTrie(
        summed.select(
            "k1", "k2", F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
            "n_children", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        ),
        found.where("size(ends) > 0").select("k1", "k2", F.col("ends")[0].alias("first"), F.col("ends").alias("ids")),
    )


def ends_digest(trie: PrefixTrie) -> DataFrame:
    """``(k1, k2, ends_sha256)``: SHA-256 of the ascending ids that end at a node, joined by commas.

    Shards are ranges of ids, so their lists follow one another by ``first``.  A digest is a
    chain and cannot be split; a node's lists stream through one task, one Arrow batch at a
    time, and are never held together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                part = ",".join(map(str, ids)).encode()
                if (k1, k2) == node:
                    digest.update(b"," + part)
                    continue
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (k1, k2), hashlib.sha256(part)
            if done:
                yield rows_of(done)
        if node is not None:
            yield rows_of([(*node, digest.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        k1, k2, digests = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(digests)], ["k1", "k2", "ends_sha256"])

    lists = trie.ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return lists.mapInArrow(run, "k1 bigint, k2 bigint, ends_sha256 string")
