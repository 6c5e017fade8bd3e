import numpy as np
import pytest

from tests.llm.conftest import SF, Union
from textloom.llm import near_vectors as V
from textloom.llm.queries import op7_embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, c string, g int, links int"


def made(seed=4):
    """Clusters of near copies, exact copies, and lone vectors under three labels."""
    rng = np.random.default_rng(seed)
    rows = []
    for label in (1, 2, 2_000_000):
        for _ in range(12):
            centre = rng.standard_normal(64)
            for _ in range(int(rng.integers(1, 14))):
                rows.append((centre + rng.uniform(0, 0.5) * rng.standard_normal(64), label))
        rows += [(rng.standard_normal(64), label) for _ in range(60)]
    rows += [rows[5]] * 4 + [rows[-1]] * 2
    order = rng.permutation(len(rows))
    return [(int(i) * 3, [float(x) for x in np.float32(rows[k][0])], rows[k][1]) for i, k in enumerate(order)]


def brute(rows):
    unit = {i: np.array(v, np.float64) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: d for i, _, d in rows}
    u, links = Union(unit), dict.fromkeys(unit, 0)
    ids = sorted(unit)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if label[a] == label[b] and unit[a] @ unit[b] >= 0.93:
                links[a] += 1
                links[b] += 1
                u.join(a, b)
    return {i: (links[i], u.root(i), u.root(i) == i) for i in unit}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("bucket, block", [(64, 512), (8, 6)])
def test_against_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(V, "BUCKET", bucket)
    monkeypatch.setattr(V, "BLOCK", block)
    rows = made()
    got, want = result(V.near_vectors(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA))), brute(rows)
    assert sum(x[0] for x in got.values()) >= 0.999 * sum(x[0] for x in want.values()) > 0
    assert all(got[i][0] <= want[i][0] for i in want) and sum(got[i] != want[i] for i in want) <= 2


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    turn = V._rotations(64)[:, :64]
    a = rng.standard_normal((400, 64))
    b = a + 0.6 * rng.standard_normal((400, 64))
    a, b = V._units(a), V._units(b)
    x, y = a @ turn, b @ turn
    factor = np.abs(y).sum(axis=1) / 8
    off = (x * np.sign(y)).sum(axis=1) / (8 * factor) - (a * b).sum(axis=1)
    bound = np.sqrt((1 - (a * b).sum(axis=1) ** 2) * (1 - factor**2) / factor**2 / 63)
    assert abs(off.mean()) < 0.01 and (np.abs(off) <= V.DEVIATIONS * bound).all()


def test_given_embeddings(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert result(op7_embedding_dedup(spark, SF)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    a = [1.0] * 64
    rows = [
        (1, a, 1), (2, a, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [], 1), (7, [0.0] * 64, 1), (8, [nan] * 64, 1),
        (9, [1.0] * 63 + [None], 1), (10, [inf] * 64, 1), (11, [1.0] * 32, 1), (12, [x * 7 for x in a], 1), (None, a, 1), (2, a, 1),
        (13, [-0.0] * 63 + [1.0], 3), (14, [0.0] * 63 + [1.0], 3), (15, [1.0], 4), (16, [2.0], 4), (17, [-2.0], 4), (18, [3e38] * 64, 5), (19, [1e-38] * 64, 5),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in V.near_vectors(df).collect())
    linked = [(0, 4, 1, False), (1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (12, 4, 1, False)]
    pairs = [(13, 1, 13, True), (14, 1, 13, False), (15, 1, 15, True), (16, 1, 15, False), (18, 1, 18, True), (19, 1, 18, False)]
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, 17)]
    assert got == sorted(linked + pairs + alone)
    assert V.near_vectors(df.limit(0)).count() == 0
