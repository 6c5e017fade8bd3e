import pathlib
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import (
    bands, candidates, components, duplicate_clusters, exact_dedup, jaccard, minhash_dedup, shingles, signatures, slot_similarity,
)
from textloom.operators import dedup
from textloom.operators.dedup import NUM_PERM, PRIME, _hex32, bands_for, permutations
from textloom.plans import shared_folder


def shingler(n):
    """The distinct n-gram hashes of a text, one word at a time."""
    factors = [1 + _hex32(f"pos{j}") % (PRIME - 1) for j in range(n)]

    def run(t):
        h = [_hex32(w) % PRIME for w in t.split()]
        return {sum(x * f % PRIME for x, f in zip(h[i:i + n], factors)) % PRIME for i in range(len(h) - n + 1)}

    return run


def text(seed, n=200):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10_000)}" for _ in range(n)]


def changed(words, at):
    out = list(words)
    for i in at:
        out[i] = "changed%d" % i
    return out


A = text(1)
HALF = changed(A, range(0, 200, 2))
CASES = {
    1: A, 2: A, 3: changed(A, [100]), 4: HALF, 5: text(2),
    10: ["too", "short"], 11: ["too", "short"], 12: ["also", "short"], 13: [], 14: [],
}


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, " ".join(w), "f1" if i % 2 else "f2") for i, w in CASES.items()] + [(20, None, "f1"), (21, None, "f2")]
    return spark.createDataFrame(rows, "doc_id int, text string, file string")


def kept(df):
    return sorted(r.doc_id for r in df.collect())


@pytest.mark.parametrize("verify", [False, True])
@pytest.mark.parametrize("floor", [None, 1])
def test_cases(cases, verify, floor):
    assert kept(minhash_dedup(cases, verify=verify, heavy_floor=floor)) == [1, 4, 5, 10, 12, 13, 20, 21]


def test_scope_keeps_files_apart(cases):
    assert kept(minhash_dedup(cases, scope_col="file")) == [1, 2, 4, 5, 10, 11, 12, 13, 14, 20, 21]


def test_parameters_are_checked(cases):
    with pytest.raises(ValueError):
        duplicate_clusters(cases, num_perm=10, b=14, r=8)
    with pytest.raises(ValueError):
        duplicate_clusters(cases, text_col="body")


def test_signature_shape(cases):
    rows = {r.doc_id: r.signature for r in signatures(cases).collect()}
    assert len(rows[1]) == 112 and rows[1] == rows[2] and rows[10] is None and rows[20] is None
    agree = sum(x == y for x, y in zip(rows[1], rows[3])) / 112
    assert agree > 0.85
    banded = bands(signatures(cases)).where("doc_id = 1").collect()
    assert sorted(r.band for r in banded) == list(range(14))


def test_long_texts_are_hashed_in_parts(spark):
    words = text(3, 20_000)
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:10_000])), (3, " ".join(words[9_996:]))], "doc_id int, text string")
    whole, left, right = (r.signature for r in signatures(df).orderBy("doc_id").collect())
    assert whole == [min(x, y) for x, y in zip(left, right)]


def test_exact_dedup(cases):
    got = {r.doc_id: r.n_copies for r in exact_dedup(cases).collect()}
    assert got == {1: 2, 3: 1, 4: 1, 5: 1, 10: 2, 12: 1, 13: 2}


def test_jaccard(spark, cases):
    pairs = spark.createDataFrame([(2, 1), (3, 1), (4, 1), (5, 1)], "a int, b int")
    got = {r.a: r.jaccard for r in jaccard(pairs, shingles(cases), heavy_floor=1).collect()}
    f = shingler(5)
    sets = {i: f(" ".join(CASES[i])) for i in (1, 2, 3, 4, 5)}
    for a in (2, 3, 4, 5):
        assert got[a] == pytest.approx(len(sets[a] & sets[1]) / len(sets[a] | sets[1]))


def test_hot_bucket_of_near_copies(spark):
    """A third of the rows are near copies; the split joins give the same result."""
    base = text(7, 300)
    rows = [(i, " ".join(changed(base, [i % 300]))) for i in range(300)] + [(1000 + i, " ".join(text(100 + i, 60))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    want = [0, *range(1000, 1600)]
    assert kept(minhash_dedup(df, heavy_floor=20)) == want == kept(minhash_dedup(df))
    assert kept(minhash_dedup(df, verify=True, heavy_floor=20)) == want


def in_bucket_clusters(docs, sets, threshold=0.75):
    """Components of all pairs that share a bucket and are similar, pair by pair."""
    buckets = {}
    for r in bands(signatures(docs)).collect():
        buckets.setdefault((r.band, r.key), []).append(r.doc_id)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for members in buckets.values():
        for a, b in combinations(sorted(members), 2):
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                ra, rb = sorted((root(a), root(b)))
                parent[rb] = ra
    return {i: root(i) for i in sets}


def test_verified_dedup_equals_all_pairs_of_its_buckets(docs):
    f = shingler(5)
    sets = {r.doc_id: f(r.text) for r in docs.collect()}
    clusters = in_bucket_clusters(docs, {i: s for i, s in sets.items() if s})
    want = {i for i, c in clusters.items() if c == i}
    assert {i for i in kept(minhash_dedup(docs, verify=True)) if sets[i]} == want


@pytest.mark.parametrize("floor", [None, 1])
def test_verified_dedup_follows_a_chain(spark, floor):
    """1 is like 2 and 2 like 3, but 1 is not like 3; 4 and 5 are like each other only."""
    base = text(11, 104)
    rows = [(1, base), (2, changed(base, [10, 11])), (3, changed(base, [10, 11, 90, 91])), (4, text(12, 104)), (5, text(12, 104) + ["x"])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id int, text string")
    f = shingler(5)
    sets = {i: f(" ".join(w)) for i, w in rows}
    jac = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert jac(1, 2) > 0.88 > 0.86 > jac(1, 3) and jac(2, 3) > 0.88
    found = duplicate_clusters(df, threshold=0.87, verify=True, b=112, r=1, heavy_floor=floor)
    assert {r.doc_id: r.cluster for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4}


def test_unlike_members_of_one_bucket_stay(spark):
    """One minimum per band: eight texts that share a sentence meet, but are unlike."""
    shared = text(20, 30)
    rows = [(i, " ".join(shared + text(30 + i, 60))) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert kept(minhash_dedup(df, verify=True, b=112, r=1)) == list(range(8))


def test_threshold_counts_or_raises(cases):
    b, r = bands_for(0.9)
    assert b * r <= NUM_PERM and abs((1 / b) ** (1 / r) - 0.9) < 0.03
    for wrong in ({"threshold": 0.9, "b": 14, "r": 8}, {"b": 14}, {"threshold": 0.0}):
        with pytest.raises(ValueError):
            duplicate_clusters(cases, **wrong)


@pytest.mark.parametrize("floor", [None, 2])
def test_components_equal_union_find(spark, floor):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]          # sparse
    edges += [(1000 + i, 1001 + i) for i in range(60)]                               # a path
    edges += [(2000, 2001 + i) for i in range(80)] + [(2500 - i, 2499) for i in range(20)]  # stars
    edges += [(3000 + i, 3000 + (i + 1) % 31) for i in range(31)]                    # a ring
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            ra, rb = sorted((root(a), root(b)))
            parent[rb] = ra
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.cluster for r in components(df, heavy_floor=floor).collect()}
    assert got == {i: root(i) for i in parent}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_leave_only_their_last_table(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long")
    root = pathlib.Path(shared_folder(spark).removeprefix("file:"), "textloom", spark.sparkContext.applicationId)
    before = set(root.glob("*"))
    assert components(edges).count() == 65
    new = [p.name for p in set(root.glob("*")) - before]
    assert len(new) == 1 and new[0].startswith("small-star")


def test_slot_similarity_is_the_share_of_equal_slots(spark):
    rng = np.random.default_rng(3)
    sigs = {i: rng.integers(0, 3, 112).tolist() for i in range(40)}
    sigs[40] = None
    signed = spark.createDataFrame(list(sigs.items()), "doc_id int, signature array<int>").repartition(3)
    pairs = [(a, b) for a in range(41) for b in (0, 1, 7) if a != b]
    df = spark.createDataFrame([(a, b, "x") for a, b in pairs], "a int, b int, keep string").repartition(4)
    for floor in (None, 5):  # 5: one document in most pairs is dealt over tasks
        got = {(r.a, r.b): r.estimate for r in slot_similarity(df, signed, heavy_floor=floor).collect()}
        assert got == {(a, b): sum(x == y for x, y in zip(sigs[a], sigs[b])) / 112 for a, b in pairs if a != 40}
    assert slot_similarity(df.limit(0), signed).count() == 0


def test_slot_similarity_is_near_the_exact_one(spark, docs):
    signed = signatures(docs)
    pairs = candidates(bands(signed))
    exact = {(r.a, r.b): r.jaccard for r in jaccard(pairs, shingles(docs)).collect()}
    guessed = {(r.a, r.b): r.estimate for r in slot_similarity(pairs, signed).collect()}
    assert exact.keys() == guessed.keys() and len(exact) > 5
    assert max(abs(exact[p] - guessed[p]) for p in exact) < 4 / (2 * 112**0.5)


def boilerplate(shared, unique):
    """A passage of ``shared`` shingles, one of which is the smallest under the first permutation by far."""
    mul, add = permutations(1)
    for k in range(100_000):
        passage = [f"s{k}x{j}" for j in range(shared + 4)]
        h = [_hex32(w) % PRIME for w in passage]
        factors = [1 + _hex32(f"pos{j}") % (PRIME - 1) for j in range(5)]
        grams = [sum(x * f % PRIME for x, f in zip(h[i:i + 5], factors)) % PRIME for i in range(shared)]
        if min((g * int(mul[0]) + int(add[0])) % PRIME for g in grams) < PRIME // unique:
            return " ".join(passage)


def test_a_shingle_that_a_whole_bucket_shares_makes_no_pairs(spark, monkeypatch):
    """5,000 unlike texts in one bucket through a passage they share, and a few near copies outside
    the bucket's largest cluster."""
    rng = random.Random(2)
    n = 5000
    passage = boilerplate(12, n * 60)
    rows = [(i, passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(60))) for i in range(n)]
    rows += [(n + k, rows[4000 + k][1] + " more") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    met, meeting = [], dedup._meeting
    monkeypatch.setattr(dedup, "_meeting", lambda r, f: met.append(meeting(r, f)) or met[-1])
    got = duplicate_clusters(df, num_perm=6, b=6, r=1, verify=True)
    assert sorted((r.doc_id, r.cluster) for r in got.collect()) == sorted(
        [(4000 + k, 4000 + k) for k in range(5)] + [(n + k, 4000 + k) for k in range(5)]
    )
    assert met[0].count() <= 5


def test_a_hot_meeting_is_dealt_and_loses_nothing(spark):
    rng = random.Random(3)
    rows = [("k", 0, e, i, i % 40, i % 40 != 7) for i in range(300) for e in ([1] if i % 3 else [1, 2 + i % 5])]
    df = spark.createDataFrame(rows, "key string, band int, e int, id long, cluster long, stray boolean").repartition(5)
    want = {
        (max(a, b) if sa and sb else (a if sa else b), min(a, b) if sa and sb else (b if sa else a))
        for (_, _, e, a, ca, sa), (_, _, f, b, cb, sb) in combinations(rows, 2) if e == f and ca != cb and (sa or sb)
    }
    for floor in (None, 100):
        got = [(r.a, r.b) for r in dedup._meeting(df, floor).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_permuted_is_the_exact_remainder():
    edge = np.array([0, 1, 2, PRIME - 2, PRIME - 1, PRIME // 2], np.uint64)
    for mul in (1, 2, PRIME // 3, PRIME - 1):
        for add in (0, 1, PRIME - 1):
            assert dedup._permuted(edge, mul, add).tolist() == [(int(h) * mul + add) % PRIME for h in edge]


def test_estimated_pairs_sign_every_text_once(spark, monkeypatch, tmp_path):
    """The query reads its signatures three times; they are made once."""
    from registry.queries import QUERIES

    signed, sets = spark.sparkContext.accumulator(0), dedup._sets

    def counting(texts, n, most=1 << 20):
        signed.add(len(texts))
        return sets(texts, n, most)

    docs = spark.createDataFrame([(i, f"a b c d e f {i // 2}", "en", "x") for i in range(40)], "doc_id bigint, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(dedup, "_sets", counting)
    assert QUERIES["dedup_pairs_estimated"](spark, str(tmp_path)).count() == 20
    assert signed.value == 40
