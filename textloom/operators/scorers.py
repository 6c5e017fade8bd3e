"""Model filters: score each document, then keep or tag it.

A scorer is a function ``(df, text_col, id_col) -> df`` that adds ``scores``, an
``array<double>`` of class probabilities in class order.  Three are provided; a
count-based one trained and applied with joins and aggregates, a linear one from
Spark ML, and one that runs a model the user brings.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from textloom.functions.arrays import attention_mask, label_of, pad_right, softmax, top1
from textloom.functions.text import collapse_newlines, words
from textloom.operators.tokens import with_ids
from textloom.plans.checks import require_absent, require_columns
from textloom.plans.barrier import computed
from textloom.plans.lineage import durable
from textloom.plans.lexicon import Fold, join_words, map_words, ship, sum_rows, within_limits

Scorer = Callable[[DataFrame, str, str], DataFrame]

UNIT = 1_000_000   # log weights are whole numbers of 1/UNIT: sums do not depend on order
MAX_CLASSES = 1000


@dataclass(frozen=True)
class NaiveBayes:
    """Multinomial Naive Bayes over words with add-one smoothing."""

    classes: Sequence
    priors: Sequence[int]
    weights: DataFrame  # word, w0, w1, ...: one bigint per class
    in_place: bool      # weights are small enough to ship to every worker

    def raw(self, df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        """Add ``raw``: log scores per class in units of ``1 / UNIT``; null for a null text.
        They depend on the text alone."""
        require_columns(df, text_col)
        if self.in_place:
            return computed(df, {"raw": self.raw_column(F.col(text_col))})
        return raw_joined(df, {"raw": self}, text_col)

    def raw_column(self, text: Column) -> Column:
        """The same as a column, for a model that fits every worker: no shuffle."""
        if not self.in_place:
            raise ValueError("the model is too large to ship; use raw()")
        shipped = ship(self.weights, "word", [f"w{i}" for i in range(len(self.priors))])
        return map_words(shipped, "array<bigint>", _sums(self.priors), pa.int64())(text)

    def __call__(self, df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        return self.raw(df, text_col, id_col).withColumn("scores", probabilities("raw")).drop("raw")


def _sums(priors: Sequence[int]) -> Fold:
    """Per row, the priors and the weights of its words; a word that is not known adds nothing."""
    first = np.array(priors, dtype=np.int64)

    def score(values: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros((1, len(first)), np.int64)  # an unknown word is at -1
        rows = sum_rows(np.concatenate([values, none])[at], offsets) + first
        return rows.ravel(), np.arange(len(rows) + 1) * len(first)

    return score


def raw_joined(df: DataFrame, models: Mapping[str, NaiveBayes], text_col: str = "text", where_col: str | None = None) -> DataFrame:
    """``df`` with the raw scores of every model, by joins of words, in one pass over the texts.  Rows
    for which the boolean column ``where_col`` is not true have none."""
    table, spans = None, {}
    for name, model in models.items():
        spans[name] = (sum(n for _, n in spans.values()), len(model.priors))
        own = model.weights.select("word", *[F.col(f"w{i}").alias(f"v{spans[name][0] + i}") for i in range(spans[name][1])])
        table = own if table is None else table.join(own, "word", "full")
    values = [c for c in table.columns if c != "word"]
    priors = [p for model in models.values() for p in model.priors]
    # a word that one model lacks adds nothing to its score
    table = table.fillna(0, values) if len(models) > 1 else table
    found = join_words(df, text_col, table, values, "__raw", "array<bigint>", _sums(priors), pa.int64(), where_col=where_col)
    return found.select(*df.columns, *[F.slice("__raw", at + 1, n).alias(name) for name, (at, n) in spans.items()])


def probabilities(raw: Column | str) -> Column:
    raw = F.col(raw) if isinstance(raw, str) else raw
    return softmax(F.transform(raw, lambda x: x / F.lit(float(UNIT))))


def _classes(labels: DataFrame, label_col: str) -> list:
    found = [r[0] for r in labels.select(label_col).where(F.col(label_col).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()]
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label_col}")
    return sorted(found)


def fit_nb(
    df: DataFrame, label_col: str, text_col: str = "text", classes: Sequence | None = None
) -> NaiveBayes:
    """Train on the labelled rows of ``df``: one pass that counts words per class."""
    require_columns(df, label_col, text_col)
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(label_col, text_col)
    names = list(classes) if classes is not None else _classes(rows, label_col)
    is_class = [F.col(label_col) == F.lit(c) for c in names]
    # one null per document rides along with its words: its group counts the documents
    tokens = F.concat(words(text_col), F.array(F.lit(None).cast("string")))
    counts = durable(
        rows.select(label_col, F.explode(tokens).alias("word"))
        .groupBy("word").agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(is_class)]),
        "nb-counts",
    )
    k = range(len(names))
    is_word = F.col("word").isNotNull()
    found = counts.agg(
        F.count("word"),
        F.sum(F.octet_length("word")),
        *[F.sum(F.when(is_word, F.col(f"n{i}"))) for i in k],
        *[F.sum(F.when(~is_word, F.col(f"n{i}"))) for i in k],
    ).first()
    vocabulary, word_bytes = found[0], found[1] or 0
    totals = [x or 0 for x in found[2 : 2 + len(names)]]
    docs = [x or 0 for x in found[2 + len(names) :]]

    def micro(x: Column) -> Column:
        return F.round(F.log(x) * F.lit(float(UNIT))).cast("long")

    weights = counts.where(is_word).select(
        "word",
        *[micro((F.col(f"n{i}") + 1).cast("double") / F.lit(float(totals[i] + vocabulary))).alias(f"w{i}") for i in k],
    )
    n_docs = sum(docs)
    priors = [round(float(np.log(docs[i] / n_docs)) * UNIT) if docs[i] else -(1 << 40) for i in k]
    return NaiveBayes(names, priors, weights, within_limits(vocabulary, word_bytes, len(names)))


def fit_linear(
    df: DataFrame, label_col: str, text_col: str = "text", features: int = 1 << 16
) -> Scorer:
    """Hashed word counts and logistic regression; classes are weighted to balance."""
    require_columns(df, label_col, text_col)
    rows = df.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label_col).count().limit(MAX_CLASSES + 1).collect()}
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label_col}")
    n = sum(sizes.values())
    weight = F.lit(0.0)
    for c, size in sizes.items():
        weight = F.when(F.col(label_col) == F.lit(c), F.lit(n / (len(sizes) * size))).otherwise(weight)
    train = rows.select(
        collapse_newlines(text_col).alias("__t"), F.col(label_col).cast("double").alias("__y"), weight.alias("__wt")
    )
    model = Pipeline(stages=[
        RegexTokenizer(inputCol="__t", outputCol="__words", pattern=r"\s+", toLowercase=False),
        HashingTF(inputCol="__words", outputCol="__x", numFeatures=features),
        LogisticRegression(
            featuresCol="__x", labelCol="__y", weightCol="__wt", probabilityCol="__p",
            rawPredictionCol="__r", predictionCol="__c", regParam=0.01, maxIter=30,
        ),
    ]).fit(train)

    def score(frame: DataFrame, text_col: str = text_col, id_col: str = "doc_id") -> DataFrame:
        filled = frame.withColumn("__t", F.coalesce(collapse_newlines(text_col), F.lit("")))
        scores = F.when(F.col(text_col).isNotNull(), vector_to_array("__p"))
        return model.transform(filled).select(*frame.columns, scores.alias("scores"))

    return score


def batch_model(make_predict_fn: Callable, batch_size: int = 256) -> Scorer:
    """A model brought by the user: ``make_predict_fn()`` loads it once per worker and
    returns a function from an array of texts to an array of class probabilities."""
    predict = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size)

    def score(frame: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        scores = predict(F.coalesce(collapse_newlines(text_col), F.lit("")))
        return computed(frame, {"scores": F.when(F.col(text_col).isNotNull(), scores)})

    return score


def tensor_scores(
    df: DataFrame, make_predict_fn: Callable, max_len: int = 256, batch_size: int = 256,
    ids_col: str = "input_ids", mask_col: str = "attention_mask",
) -> DataFrame:
    """``df`` with ``logits`` and ``scores`` (their softmax) of rows of ``max_len`` token ids and
    their mask, as ``truncate_pad`` makes them.

    ``make_predict_fn()`` loads the user's model once per worker and returns a function from two
    whole-number tensors of ``batch_size`` x ``max_len``, ids and mask, to logits, one row of
    classes each.  A row without ids is not shown to the model and has neither.
    """
    require_columns(df, ids_col, mask_col)
    require_absent(df, "logits", "scores")
    predict = predict_batch_udf(
        make_predict_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size, input_tensor_shapes=[[max_len], [max_len]]
    )
    there = F.col(ids_col).isNotNull() & F.col(mask_col).isNotNull()
    blank = F.array_repeat(F.lit(0), max_len)  # stands in for a missing row, as tensors have no nulls
    tensors = [F.when(there, F.col(c).cast("array<int>")).otherwise(blank) for c in (ids_col, mask_col)]
    scored = computed(df, {"logits": F.when(there, predict(*tensors))})
    return scored.withColumn("scores", softmax("logits"))


def tensor_model(
    make_predict_fn: Callable, vocabulary: DataFrame, max_len: int = 256, pad_id: int = 0, bos_id: int | None = None,
    unk_id: int | None = None, batch_size: int = 256,
) -> Scorer:
    """A scorer that turns texts into fixed-length rows of ids and masks and gives them to the
    user's model (``tensor_scores``)."""

    def score(frame: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
        ids = with_ids(frame, vocabulary, "__input_ids", bos_id, unk_id, text_col)
        rows = ids.withColumns({
            "__mask": F.when(F.col("__input_ids").isNotNull(), attention_mask("__input_ids", max_len)),
            "__input_ids": pad_right("__input_ids", pad_id, max_len),
        })
        return tensor_scores(rows, make_predict_fn, max_len, batch_size, "__input_ids", "__mask").select(*frame.columns, "scores")

    return score


# --- the three filters ------------------------------------------------------------


def quality_pass(scores: Column | str, target: int, threshold: float = 0.5) -> Column:
    """Best class is the target and its probability reaches the threshold; a row
    without scores does not pass."""
    s = F.col(scores) if isinstance(scores, str) else scores
    return F.coalesce((top1(s) == target) & (F.array_max(s) >= threshold), F.lit(False))


def quality_filter(
    df: DataFrame, scorer: Scorer, target: int = 1, threshold: float = 0.5,
    text_col: str = "text", id_col: str = "doc_id",
) -> DataFrame:
    """Keep rows of the target class; ``pass_filter`` stays in the output."""
    scored = scorer(df, text_col, id_col)
    marked = scored.select(*df.columns, quality_pass("scores", target, threshold).alias("pass_filter"))
    return marked.where("pass_filter")


def toxic_predictions(df: DataFrame, scorer: Scorer, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` with ``predictions``, the position of the best class."""
    return scorer(df, text_col, id_col).select(*df.columns, top1("scores").alias("predictions"))


def toxic_filter(df: DataFrame, scorer: Scorer, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    return toxic_predictions(df, scorer, text_col, id_col).where("predictions = 0")


def toxic_rejects(df: DataFrame, scorer: Scorer, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    return toxic_predictions(df, scorer, text_col, id_col).where("predictions = 1")


def tag_domain(
    df: DataFrame, scorer: Scorer, id2label: Mapping[int, str], text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """``df`` with ``domains``, the name of the best class.  No row is dropped."""
    scored = scorer(df, text_col, id_col)
    return scored.select(*df.columns, label_of(top1("scores"), id2label).alias("domains"))
