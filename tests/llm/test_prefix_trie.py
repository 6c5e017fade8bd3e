import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tests.llm.conftest import SF
from textloom.llm.prefix_trie import ends_digest, prefix_trie
from textloom.llm.queries import op11_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows):
    """Nodes by whole prefixes, recursively."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    talks = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % 5) * (1 if c >= 0 else -1)
        talks[c] = [*own.get(base, [])[:h], *own[c][h:]]
    members = defaultdict(list)
    for c in sorted(talks):
        for d in range(len(talks[c]) + 1):
            members[tuple(talks[c][:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(talks[c]) == len(p))
        parent = members[p[:-1]][0] if p else None
        out.append((m[0], len(p), parent, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(trie):
    nothing = hashlib.sha256(b"").hexdigest()
    rows = trie.nodes.join(ends_digest(trie), ["k1", "k2"], "left").fillna(nothing, ["ends_sha256"]).select(COLUMNS).collect()
    return sorted(map(tuple, rows), key=repr)


def test_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op11_prefix_trie(spark, SF)
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_shared_prefixes_over_shards_and_slabs(spark):
    """Thousands of conversations over several shards, few different turns, long ones in slabs of
    three positions, one conversation with a third of all rows."""
    rng = random.Random(4)
    rows = []
    for c in rng.sample(range(-40, 3000), 1300):
        n = rng.choice([1, 2, 3, 3, 5, 8, 14])
        rows += [(c, t, rng.choice(["user", "", None]), rng.choice(["a", "bb", "ü"]) if t < 2 or rng.random() < 0.9 else str(c)) for t in range(n)]
    rows += [(7, t, "user", "a") for t in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    want = brute(rows)
    assert found(prefix_trie(df, slab=3)) == want
    assert max(w[1] for w in want) > 2000 and max(w[3] for w in want) > 1000


def test_odd_rows(spark):
    long = "word " * 50_000
    rows = [
        (0, None, None, None), (0, 1, "user", long), (0, 1, "user", "tie"), (0, 1, "assistant", "tie"), (0, 2, "user", ""),
        (1, 1, "user", "x"), (1, 1, "user", "x"), (2, None, "", ""), (None, 1, "user", "no conversation"), (3, 5, "user", None), (-4, 1, "a", "b"),
        *[(c, 0, "user", "same") for c in range(100, 140)], *[(c, 1, "user", f"end {c % 3}") for c in range(100, 140)],
    ]
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "conv_id int, turn int, role string, text string, depth int, k1 string, bit int")
    assert found(prefix_trie(df)) == brute(rows)
    assert prefix_trie(df.limit(0)).nodes.count() == 0
    assert found(prefix_trie(df.where("conv_id = 3"))) == brute([(3, 5, "user", None)])


def test_conversations_without_turns_are_members_of_the_root(spark):
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lone, 0, "user", "taken by nobody")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(prefix_trie(df)) == brute(rows) and len(brute(rows)) == 1


@pytest.mark.parametrize("slab", [1, 2])
def test_every_slab_width(spark, slab):
    rows = [(c, t, "u", "same" if t < c % 4 else f"{c} {t}") for c in range(60) for t in range(c % 7 + 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(prefix_trie(df, slab=slab)) == brute(rows)
