import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, SF, python_free
from textloom.llm.mixing import DomainModel, document_rates, fit_domain_model, fit_mix, mixed
from textloom.llm.queries import WEIGHTS, domain, op4_mixing


@pytest.fixture(scope="module")
def model(spark, docs):
    return fit_domain_model(docs, spark.read.parquet(f"{SF}/labels.parquet"), domain())


def test_expected_tokens_meet_the_targets(spark, docs, model):
    mix = fit_mix(docs, model, WEIGHTS)
    assert set(mix.targets) == set(WEIGHTS) and sum(mix.targets.values()) == pytest.approx(docs.selectExpr(r"sum(size(array_remove(split(text, '\\s+'), '')))").first()[0])
    assert all(abs(mix.expected[d] - mix.targets[d]) <= 1e-3 * sum(mix.targets.values()) for d in WEIGHTS)
    df = document_rates(docs, mix)
    assert python_free(df)
    rows = df.collect()
    assert len(rows) == docs.count() and all(r.rate >= 0 and r.epochs in (int(r.rate), int(r.rate) + 1) for r in rows)


def test_query(spark, docs):
    rows = op4_mixing(spark, SF).collect()
    assert len(rows) == docs.count() and {r.domain for r in rows} <= set(WEIGHTS)


def test_a_least_rate_keeps_every_document(docs, model):
    mix = fit_mix(docs, model, WEIGHTS, least=1.0)
    rows = {r.doc_id: r for r in document_rates(docs, mix).collect()}
    assert all(r.rate >= 1 and r.epochs >= 1 for r in rows.values())
    out = mixed(docs, mix)
    assert out.columns == docs.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {i: r.epochs for i, r in rows.items()}


def test_posteriors_separate_what_differs(spark):
    docs = spark.createDataFrame([(i, ("apple pear plum " if i % 2 else "iron zinc lead ") * 9) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, "fruit" if i % 2 else "metal") for i in range(10)] + [(None, "x"), (3, None)], "doc_id long, d string")
    model = fit_domain_model(docs, labels, F.col("d"))
    mix = fit_mix(docs, model, {"fruit": 3, "metal": 1})
    rows = document_rates(docs, mix).collect()
    assert all(r.domain == ("fruit" if r.doc_id % 2 else "metal") and r.posterior > 0.9 for r in rows)
    assert [mix.expected[d] / 1080 for d in ("fruit", "metal")] == pytest.approx([0.75, 0.25], abs=1e-3)
    far = fit_mix(docs, model, {"fruit": 1})
    assert all((r.rate < 0.05) == (r.domain == "metal") for r in document_rates(docs, far).collect())


def test_odd_rows(spark, odd, none, docs, model):
    mix = fit_mix(odd, model, WEIGHTS)
    rows = document_rates(odd, mix).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((i or 0, len((t or "").split())) for i, t in ODD)
    assert mixed(odd, mix).columns == odd.columns
    assert document_rates(none, fit_mix(none, model, WEIGHTS)).count() == 0
    nothing = fit_domain_model(docs, spark.createDataFrame([], "doc_id long, d string"), F.col("d"))
    assert nothing == DomainModel((), (), ()) and mixed(odd, fit_mix(odd, nothing, WEIGHTS)).count() == len(ODD)
    assert {r.rate for r in document_rates(odd, fit_mix(odd, nothing, WEIGHTS)).collect()} == {1.0}


def by_hand(texts, labels, weights, least=0.0):
    """Posteriors and rates in plain numbers: counts of hashed words, then projected-gradient steps."""
    def buckets(t):
        return [xxhash.xxh64(w.encode(), seed=42).intdigest() % 4096 for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower()) if w]

    words = {i: buckets(t or "") for i, t in texts.items()}
    names = sorted({d for d in labels.values()})
    counts = np.zeros((len(names), 4096))
    for i, d in labels.items():
        np.add.at(counts[names.index(d)], words[i], 1)
    logs = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * 4096))
    logs = np.round((logs - logs.mean(axis=0)) * 1e6)
    priors = np.log(np.array([sum(d == n for d in labels.values()) for n in names]) / len(labels))
    p, t = np.zeros((len(texts), len(names))), np.zeros(len(texts))
    for row, w in enumerate(words.values()):
        z = priors + logs[:, w].sum(axis=1) * min(len(w), 32) / max(len(w), 1) / 1e6
        p[row], t[row] = np.exp(z - z.max()) / np.exp(z - z.max()).sum(), len(w)
    targets = np.array([weights.get(n, 0.0) for n in names])
    targets = targets / targets.sum() * t.sum()
    gram = (p * t[:, None]).T @ p
    rates, best = np.ones(len(texts)), None
    for step in range(31):
        reached = (p * (t * rates)[:, None]).sum(axis=0)
        off = abs(reached - targets).sum() / t.sum()
        best = min(best, (off, step, rates.tolist())) if best else (off, step, rates.tolist())
        if off < 1e-4:
            break
        rates = np.maximum(least, rates - p @ np.linalg.solve(gram, reached - targets))
    return names, p, np.array(best[2])


@pytest.mark.parametrize("weights", [WEIGHTS, {"q0t0": 0.5, "q1t1": 0.3, "q1t0": 0.2}, {"q0t1": 0.6, "q1t0": 0.4}])
def test_posteriors_and_rates_by_hand(spark, docs, model, weights):
    """Targets near the labelled shares and far from them, with domains that get nothing."""
    texts = {r.doc_id: r.text for r in docs.orderBy("doc_id").collect()}
    rows = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", domain().alias("d")).collect()
    names, p, rates = by_hand(texts, {r.doc_id: r.d for r in rows if r.doc_id in texts and r.d}, weights)
    got = {r.doc_id: r for r in document_rates(docs, fit_mix(docs, model, weights)).collect()}
    assert tuple(names) == model.domains
    for k, i in enumerate(texts):
        assert got[i].posterior == pytest.approx(p[k].max(), abs=1e-6) and got[i].domain == names[p[k].argmax()]
        assert got[i].rate == pytest.approx(rates[k], rel=1e-4, abs=1e-4)
    assert (rates == 0).any() or weights is WEIGHTS
