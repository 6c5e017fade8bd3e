from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import (
    Recipe, corpus_summary, count_tokens, domain_distribution, drop_empty_text, filter_funnel, heur_filter, heur_stats,
    token_stats,
)
from textloom.plans.lexicon import SLICE_BYTES, text_parts

TEXT = "Ab, 12!\nab\nab\n x"


def test_stats_of_one_text(spark):
    df = spark.createDataFrame([(1, TEXT)], "doc_id int, text string")
    r = heur_stats(df).first()
    n = len(TEXT)
    assert r.text_length == n and r.word_count == 5
    assert r.alnum_ratio == pytest.approx(sum(c.isalnum() for c in TEXT) / n)
    assert r.special_ratio == pytest.approx(2 / n)
    assert r.mean_line_length == pytest.approx(sum(map(len, TEXT.split("\n"))) / 4)
    assert r.max_line_length == 7
    assert r.repeated_line_ratio == pytest.approx(0.25)


def test_repetition(spark):
    text = "a b c a b c x \U0001f600 b c"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")
    rows = {r.doc_id: r for r in heur_stats(df, ["word_repetition", "char_repetition"], Recipe(word_gram=2, char_gram=3)).collect()}

    def share(grams):
        c = Counter(grams).values()
        return sum(v for v in c if v > 1) / sum(c)

    w = text.split()
    assert rows[1].word_repetition == pytest.approx(share(zip(w, w[1:])))
    assert rows[1].char_repetition == pytest.approx(share(text[i:i + 3] for i in range(len(text) - 2)))
    assert rows[2].word_repetition == 0.0 and rows[3].word_repetition is None


def test_empty_and_null_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "doc_id int, text string")
    rows = {r.doc_id: r for r in heur_stats(df).collect()}
    assert rows[1].word_count == 0 and rows[1].alnum_ratio == 0.0 and rows[2].word_count is None
    assert heur_filter(df, Recipe(bounds=[("word_count", 0, 5)])).collect()[0].doc_id == 1
    assert drop_empty_text(df).count() == 0


def test_bounds_and_languages(spark):
    df = spark.createDataFrame([(1, "a b", "en"), (2, "a b c", "en"), (3, "a", "en"), (4, "a b", "vi")], "doc_id int, text string, lang string")
    recipe = Recipe(bounds=[("word_count", 2, 2), ("text_length", None, 10)], languages=["en"])
    assert [r.doc_id for r in heur_filter(df, recipe).collect()] == [1]
    kept = heur_filter(df, recipe, keep_stats=True)
    assert kept.columns == ["doc_id", "text", "lang", "word_count", "text_length"]
    assert heur_filter(df, Recipe(languages=["vi"])).count() == 1


def test_unknown_rule(spark):
    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError, match="unknown rule"):
        heur_stats(df, ["nope"])


def test_word_lists(spark):
    df = spark.createDataFrame([("the cat the",), ("",)], "text string")
    got = heur_stats(df, ["stop_word_ratio"], Recipe(stop_words=["the"])).collect()
    assert [r.stop_word_ratio for r in got] == [pytest.approx(2 / 3), 0.0]


def test_token_stats(spark):
    counts = [1, 5, 9, 100, 7]
    df = spark.createDataFrame([(c,) for c in counts], "n_tokens int")
    r = token_stats(df).first()
    assert (r.examples, r.total_tokens, r.max_tokens) == (5, 122, 100)
    assert r.p95_tokens == pytest.approx(np.percentile(counts, 95)) and r.mean_tokens == pytest.approx(np.mean(counts))
    empty = token_stats(df.where("n_tokens < 0")).first()
    assert tuple(empty) == (0, None, None, None, None)
    assert token_stats(df.where("n_tokens = 7")).first().p95_tokens == 7.0


def test_summaries(spark):
    df = spark.createDataFrame([("g", "a", "một hai"), ("g", "b", "x"), ("h", "a", "")], "grp string, source string, text string")
    rows = {(r.grp, r.source): (r.samples, r.tokens, r.bytes) for r in corpus_summary(count_tokens(df), ["grp", "source"]).collect()}
    assert rows == {
        ("g", "a"): (1, 2, len("một hai".encode())), ("g", "b"): (1, 1, 1), ("h", "a"): (1, 0, 0),
        ("g", "Total"): (2, 3, 10), ("h", "Total"): (1, 0, 0), ("Total", "Total"): (3, 3, 10),
    }
    shares = domain_distribution(df.withColumnRenamed("source", "domains"))
    assert {r.domains: (r.n, round(r.share, 4)) for r in shares.collect()} == {"a": (2, 0.6667), "b": (1, 0.3333)}
    assert tuple(filter_funnel(df, F.col("text") != "").first()) == (3, 2)


def test_repetition_works_on_slices_of_a_batch(spark):
    """What a worker holds at once follows from the bytes of texts, not from the rows of a batch."""
    texts = pa.array(["a b " * 50_000, None, "", "x y z"] * 40)  # 8 MB
    parts = list(text_parts(texts))
    assert len(parts) >= 2 and sum(map(len, parts)) == len(texts) and pa.concat_arrays(parts).equals(texts)
    assert max(p.nbytes for p in parts) <= SLICE_BYTES + (1 << 10)
    assert [len(p) for p in text_parts(texts.slice(0, 5), 1)] == [1, 2, 1, 1]
    df = spark.createDataFrame([(i, None if i % 11 == 0 else "a b c " * (i % 13) + str(i)) for i in range(500)], "doc_id int, text string").coalesce(1)
    rules, recipe = ["word_repetition", "char_repetition"], Recipe(word_gram=2, char_gram=3)
    want = {r.doc_id: tuple(r)[2:] for r in heur_stats(df, rules, recipe).collect()}
    alone = {r.doc_id: tuple(r)[2:] for r in heur_stats(df.repartition(40), rules, recipe).collect()}
    assert want == alone and want[11] == (None, None) and len(set(want.values())) > 10
