from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.llm.conftest import LONG, ODD, SF, python_free
from tests.llm.test_decontaminate import normal
from tests.llm.test_near_text import brute
from textloom.llm.mixing import _profiled, fit_domain_model
from textloom.llm.queries import QUERIES, WEIGHTS, domain
from textloom.plans import durable


def test_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert sorted(n[:n.index("_") + 1] for n in QUERIES) == sorted(names)
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())


def test_every_stage_on_its_own_input(spark, docs):
    sizes, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, SF)
        if name == "shard":
            assert python_free(out)
        before, now = now, durable(out, name)
        sizes.append(now.count())
        ids = [r.doc_id for r in now.select("doc_id").collect()]
        texts = {r.doc_id: r.text for r in before.collect()}
        if name == "language":
            lettered = {i for i, t in texts.items() if any(c.isalpha() for c in t)}
            assert set(ids) <= lettered and len(ids) >= 0.98 * len(lettered)
        elif name == "near_dedup":
            assert sorted(ids) == sorted(i for i, (_, _, kept) in brute(texts).items() if kept)
        elif name == "decontaminate":
            items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(ids) == {i for i, t in texts.items() if not any(x in normal(t) for x in items)}
        elif name == "mix":
            assert set(ids) == set(texts) and len(ids) > len(texts)
        if name != "shard":
            assert now.columns == docs.columns
    assert sizes[-1] == sizes[-2]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    slots = {}
    for r in rows.select("shard", "slot").collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and corpus_pipeline.ORACLE_SQL is None


def test_empty_input(spark, docs):
    now = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.count() == 0


def test_the_mix_stage_reaches_the_weights_of_op4(spark, docs):
    """Shares of the tokens that its rows hold, by the posteriors of the same model."""
    model = fit_domain_model(docs, spark.read.parquet(f"{SF}/labels.parquet"), domain())
    rows = corpus_pipeline.mix(spark, docs, SF).groupBy("doc_id").count()
    profiles = _profiled(docs, model, "text", [F.col("doc_id")]).join(rows, "doc_id")
    sums = profiles.agg(*[F.sum(F.col("count") * F.col("t") * F.get("p", F.lit(k))) for k in range(len(model.domains))]).first()
    reached = {d: x / sum(sums) for d, x in zip(model.domains, sums)}
    assert set(reached) == set(WEIGHTS) and all(abs(reached[d] - WEIGHTS[d]) <= 0.02 for d in WEIGHTS)


def test_odd_rows_through_every_stage(spark, odd):
    """Nulls in any column, empty and long texts, ties, repeated rows and columns with the operators' names."""
    texts = {(i, t) for i, t in ODD}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        rows = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
        assert set(rows) <= texts and (name == "shard" or out.columns == odd.columns)
        if name == "language":
            assert all(any(c.isalpha() for c in t or "") for _, t in rows) and (7, LONG) in rows
        elif name == "near_dedup":
            assert sorted(i or 0 for i, _ in rows) == [0, 0, 1, 2, 3, 4, 5, 7, 8, 9]
        elif name == "decontaminate":
            assert sorted(map(repr, rows)) == sorted(map(repr, ODD))
        elif name == "mix":
            assert set(rows) == texts and len(rows) >= len(ODD)
        else:
            assert len(rows) == len(ODD)
