import random
import re
from itertools import combinations

import pytest

from tests.llm.conftest import ODD, SF, Union
from textloom.llm import near_text
from textloom.llm.near_text import near_duplicates, without_near_duplicates
from textloom.llm.queries import op6_minhash_dedup


def shingles(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    u = Union(texts)
    for a, b in combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            u.join(a, b)
    return {i: (len(sets[i]), u.root(i), u.root(i) == i) for i in texts}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def changed(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randrange(10**9)}"
    return out


@pytest.fixture(scope="module")
def group():
    """Copies of one text with 0 to 14 changed words, a chain, and unrelated texts."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(5000)}" for _ in range(160)]
    texts = {100 + k: " ".join(changed(base, k % 15, rng)) for k in range(120)}
    texts |= {400 + k: " ".join(f"v{rng.randrange(5000)}" for _ in range(40)) for k in range(30)}
    step = [f"c{rng.randrange(5000)}" for _ in range(120)]
    for k in range(6):
        texts[50 - k] = " ".join(step)
        step = changed(step, 3, rng)
    return texts


def test_given_documents(spark, docs):
    assert result(op6_minhash_dedup(spark, SF)) == brute({r.doc_id: r.text for r in docs.collect()})


@pytest.mark.parametrize("block, dealt", [(256, 256), (8, 5)])
def test_hard_group(spark, group, monkeypatch, block, dealt):
    monkeypatch.setattr(near_text, "BLOCK", block)
    monkeypatch.setattr(near_text, "DEALT", dealt)
    df = spark.createDataFrame(list(group.items()), "doc_id long, text string")
    assert result(near_duplicates(df)) == brute(group)


def test_odd_rows(spark, odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 3, 5, True), (6, 3, 5, False), (None, 1, None, True), (None, 0, None, True)} <= got
    kept = without_near_duplicates(odd, near_duplicates(odd))
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9]
    assert near_duplicates(none).count() == 0 and without_near_duplicates(none, near_duplicates(none)).count() == 0


def test_rows_that_share_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(5, a), (5, b), (3, b), (7, a), (5, a)], "doc_id long, text string")
    found = near_duplicates(df)
    assert {(r.doc_id, r.component_id, r.kept) for r in found.collect()} == {(5, 3, False), (3, 3, True), (7, 3, False)}
    same = spark.createDataFrame([(1, a), (1, a), (1, b)], "doc_id long, text string")
    assert [r.doc_id for r in without_near_duplicates(same, near_duplicates(same)).collect()] == [1]


@pytest.mark.parametrize("parts", [1, 7])
def test_every_text_of_an_id_keeps_its_links(spark, parts):
    """Twenty ids that hold two unlike texts each, and near copies of both under other ids: whatever
    the order of the rows, the three ids are one component."""
    rng = random.Random(11)
    rows, want = [], {}
    for k in range(20):
        a, b = ([f"{x}{k}w{rng.randrange(10**6)}" for _ in range(60)] for x in "ab")
        one, two, three = 3 * k, 3 * k + 1, 3 * k + 2  # the smallest id holds both texts
        rows += [(one, " ".join(a)), (one, " ".join(b)), (two, " ".join(changed(a, 1, rng))), (three, " ".join(changed(b, 1, rng)))]
        want |= dict.fromkeys((one, two, three), one)
    rng.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == set(want.items())


def test_an_id_with_many_texts_joins_their_groups(spark):
    rng = random.Random(12)
    texts = [" ".join(f"t{k}w{rng.randrange(10**6)}" for _ in range(30)) for k in range(40)]
    rows = [(9, t) for t in texts] + [(100 + k, t + " more") for k, t in enumerate(texts)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert {r.component_id for r in found.collect()} == {"100"} and found.count() == 80
