import math
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import (
    CorpusConfig, Recipe, batch_model, clean_corpus, fit_linear, fit_nb, funnel, quality_filter, tag_domain,
    toxic_filter, toxic_predictions, toxic_rejects,
)
from textloom.operators.scorers import quality_pass

ROWS = [(1, "good fine good", 1), (2, "bad awful", 0), (3, "good bad", 1), (4, "unseen words", None), (5, None, 1), (6, "", None)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "doc_id int, text string, quality int")


def by_hand(text):
    train = [(t, y) for _, t, y in ROWS if t is not None and y is not None]
    counts = {c: Counter(w for t, y in train if y == c for w in t.split()) for c in (0, 1)}
    vocabulary = set(counts[0]) | set(counts[1])
    out = []
    for c in (0, 1):
        s = round(math.log(sum(y == c for _, y in train) / len(train)) * 1e6)
        total = sum(counts[c].values()) + len(vocabulary)
        s += sum(round(math.log((counts[c][w] + 1) / total) * 1e6) for w in text.split() if w in vocabulary)
        out.append(s)
    return out


def test_naive_bayes_by_hand(rows):
    nb = fit_nb(rows, "quality")
    got = {r.doc_id: r.raw for r in nb.raw(rows).collect()}
    assert nb.in_place and nb.classes == [0, 1]
    for i, t, _ in ROWS:
        assert got[i] == (None if t is None else by_hand(t))


def test_shipped_and_joined_weights_agree(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    nb = fit_nb(docs.join(labels, "doc_id"), "toxic")
    joined = replace(nb, in_place=False)
    a, b = (m.raw(docs).select("doc_id", "raw") for m in (nb, joined))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == docs.count()


def test_repeated_and_null_ids_do_not_matter(spark, rows):
    """A score depends on the text alone, in both ways."""
    nb = fit_nb(rows, "quality")
    df = spark.createDataFrame(
        [(1, "good fine"), (1, "bad good"), (None, "good fine"), (7, None), (7, ""), (8, "good fine")], "doc_id int, text string"
    )
    want = sorted((i or 0, t or "", None if t is None else by_hand(t)) for i, t in [tuple(r) for r in df.collect()] if t is not None)
    for model in (nb, replace(nb, in_place=False)):
        got = [(r.doc_id or 0, r.text, r.raw) for r in model.raw(df).collect()]
        assert sorted(g for g in got if g[1] is not None) == want and [g[2] for g in got if g[1] is None] == [None]


def test_a_later_filter_reaches_the_scan_and_python_runs_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    nb = fit_nb(docs.join(labels, "doc_id"), "toxic", classes=(0, 1))
    for df in (toxic_filter(docs, nb), quality_filter(docs, nb), tag_domain(docs, nb, {0: "a", 1: "b"})):
        plan = df.where("lang = 'en'")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(lang,en)" in plan and plan.count("ArrowEvalPython [") == 1


def test_filters_keep_and_tag(rows):
    nb = fit_nb(rows, "quality")
    kept = quality_filter(rows, nb)
    assert kept.columns == [*rows.columns, "pass_filter"]
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 6}
    assert {r.doc_id: r.predictions for r in toxic_predictions(rows, nb).collect()} == {1: 1, 2: 0, 3: 1, 4: 1, 5: None, 6: 1}
    assert {r.doc_id for r in toxic_filter(rows, nb).collect()} == {2}
    assert {r.doc_id for r in toxic_rejects(rows, nb).collect()} == {1, 3, 4, 6}
    tagged = {r.doc_id: r.domains for r in tag_domain(rows, nb, {0: "low", 1: "high"}).collect()}
    assert tagged[2] == "low" and tagged[1] == "high" and tagged[5] is None and len(tagged) == 6


def test_threshold_is_inclusive_and_ties_go_to_the_first(spark):
    df = spark.createDataFrame([([0.5, 0.5],), ([0.2, 0.8],), ([0.4, 0.3, 0.3],), (None,)], "s array<double>")
    assert [r[0] for r in df.select(quality_pass("s", 0, 0.5)).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(quality_pass("s", 1, 0.8)).collect()] == [False, True, False, False]


def test_user_model(spark):
    def make():
        def predict(texts):
            p = np.array([0.9 if "good" in t else 0.1 for t in texts])
            return np.stack([1 - p, p], axis=1)
        return predict

    df = spark.createDataFrame([(1, "a\n\ngood"), (2, "x"), (3, None)], "doc_id int, text string")
    assert [r.doc_id for r in quality_filter(df, batch_model(make, 2)).collect()] == [1]


def test_linear_scorer_ranks_better_than_chance(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    train = docs.join(labels, "doc_id")
    scored = fit_linear(train, "quality", features=1 << 12)(train).select("quality", F.col("scores")[1].alias("p")).collect()
    good = [r.p for r in scored if r.quality == 1]
    bad = [r.p for r in scored if r.quality == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.8


def test_corpus_job_gives_one_status_per_document(spark):
    text = " ".join(f"good{i}" for i in range(30))
    data = [(1, text), (2, text), (3, "short"), (4, None), (5, "bad " * 20), (6, "vile " * 20), (7, text + " end more words here now")]
    df = spark.createDataFrame([(i, t, "en") for i, t in data], "doc_id int, text string, lang string")

    def model(word):
        def make():
            return lambda texts: np.array([[0.1, 0.9] if word in t else [0.9, 0.1] for t in texts])
        return batch_model(make)

    def fine():
        return lambda texts: np.array([[0.9, 0.1] if "bad" in t else [0.1, 0.9] for t in texts])

    config = CorpusConfig(Recipe(bounds=[("word_count", 5, None)]), batch_model(fine), model("vile"), model("good"), {0: "a", 1: "b"})
    out = clean_corpus(df, config)
    got = {r.doc_id: (r.status, r.domains, r.n_tokens) for r in out.collect()}
    assert got == {
        1: ("kept", "b", 30), 2: ("duplicate", None, None), 3: ("heuristic", None, None), 4: ("heuristic", None, None),
        5: ("quality", None, None), 6: ("toxic", None, None), 7: got[7],
    }
    steps = [(r.stage, r.rows_in, r.rows_out) for r in funnel(out).orderBy("step").collect()]
    assert steps[:3] == [("heuristic", 7, 5), ("quality", 5, 4), ("toxic", 4, 3)] and steps[3][2] == sum(s == "kept" for s, *_ in got.values())


def load_small_model():
    """Logits from ids and mask by hand: class k adds (id + k) % 3 of the unmasked ids."""
    def predict(ids, mask):
        assert ids.shape == mask.shape and ids.shape[1] == 6
        return np.stack([(((ids + k) % 3) * mask).sum(axis=1).astype(float) for k in range(3)], axis=1)

    return predict


def logits_by_hand(ids, length=6):
    return [float(sum((i + k) % 3 for i in ids[:length])) for k in range(3)]


def test_tensor_scores_of_token_rows(spark):
    from textloom.operators import tensor_scores, truncate_pad

    lists = {1: [5, 3], 2: [], 3: list(range(20)), 4: [7] * 6, 5: None, 6: [2, 2, 2, 2, 2, 2, 2]}
    rows = spark.createDataFrame([(k, v, "x") for k, v in lists.items()], "doc_id int, input_ids array<int>, keep string").repartition(2)
    padded = truncate_pad(rows, 0, 6).withColumn("input_ids", F.when(F.col("doc_id") != 5, F.col("input_ids")))
    for batch in (1, 2, 256):
        got = {r.doc_id: r for r in tensor_scores(padded, load_small_model, 6, batch).collect()}
        assert got[5].logits is None and got[5].scores is None and all(r.keep == "x" for r in got.values())
        for k, v in lists.items():
            if v is not None:
                want = logits_by_hand(v)
                assert got[k].logits == want
                powers = [math.exp(x - max(want)) for x in want]
                assert got[k].scores == pytest.approx([p / sum(powers) for p in powers])
    assert tensor_scores(padded.limit(0), load_small_model, 6).count() == 0
    with pytest.raises(ValueError, match="overwritten"):
        tensor_scores(padded.withColumn("scores", F.lit(1)), load_small_model, 6)


def test_tensor_model_is_a_scorer(spark, rows):
    from textloom.operators import build_vocabulary, encode, tensor_model, tensor_scores, truncate_pad

    vocabulary = build_vocabulary(rows, first_id=2)
    scorer = tensor_model(load_small_model, vocabulary, 6, pad_id=0, bos_id=1, unk_id=9)
    got = {r.doc_id: r.scores for r in scorer(rows).collect()}
    known = encode(rows.where("text is not null"), vocabulary, bos_id=1, unk_id=9)
    want = {r.doc_id: r.scores for r in tensor_scores(truncate_pad(known, 0, 6), load_small_model, 6).collect()}
    assert got[5] is None and {k: v for k, v in got.items() if k != 5} == want
    tagged = {r.doc_id: r.predictions for r in toxic_predictions(rows, scorer).collect()}
    assert all(tagged[k] == v.index(max(v)) for k, v in want.items()) and tagged[5] is None
    assert set(scorer(rows.withColumn("scores_old", F.lit(1))).columns) == {*rows.columns, "scores_old", "scores"}


def test_joined_models_share_one_pass(spark, docs, monkeypatch):
    """The whole job with models too large to ship: the statuses and domains of shipped ones,
    and the texts are put in chunks once for all three models."""
    from textloom.plans import lexicon

    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = docs.join(labels, "doc_id")
    models = [fit_nb(rows, "quality", classes=(0, 1)), fit_nb(rows, "toxic", classes=(0, 1)), fit_nb(docs, "lang", classes=("de", "en", "es", "fr"))]
    recipe = Recipe(bounds=(("word_count", 20, 20000),))
    calls, in_chunks = [], lexicon._in_chunks
    monkeypatch.setattr(lexicon, "_in_chunks", lambda *a: calls.append(1) or in_chunks(*a))

    def statuses(in_place):
        config = CorpusConfig(recipe, *[replace(m, in_place=in_place) for m in models], dict(enumerate(("de", "en", "es", "fr"))))
        return {r.doc_id: (r.status, r.domains, r.n_tokens) for r in clean_corpus(docs, config).collect()}

    want, n = statuses(True), len(calls)
    got = statuses(False)
    assert got == want and (n, len(calls)) == (0, 1) and len({s for s, _, _ in got.values()}) > 2
