"""Language identification in two steps: first the family, then the language within it.

Features are frequencies of hashed 3- and 4-grams of lower-case bytes.  One linear
support vector machine per family tells it from all others; within a family one machine
per pair of languages votes (one versus one).  A score is a mean of weights over the
n-grams of the whole text, so a text of any length is read once, in slices.

Machines that only tell languages apart find one for any text.  How usual a text is for
its language is therefore measured beside: the mean log frequency of its n-grams, in
standard deviations from that of labelled texts that the frequencies were not counted on.
Noise and languages that were not learned lie far below them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textloom.llm.batches import byte_slices, field, flat, map_batches, sums
from textloom.plans import durable

# Families of common languages.  A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi mr ne bn",
    "arabic": "ar fa ur",
}
FAMILY_OF = {lang: name for name, langs in FAMILIES.items() for lang in langs.split()}

HASH_BITS = 13
SIZE = 2 << HASH_BITS        # 3-grams in the lower half, 4-grams in the upper
SAMPLE = 300                 # texts per language that a model is fitted on, about
STEPS, PENALTY = 150, 1e-4   # of the solver
UNKNOWN = "und"
RARE = 1e-5                  # frequency of an n-gram that the sample does not hold
OVERLAP = 8                  # n-grams that share a byte, about: so many count as one observation
LEAST_SPREAD = 0.05          # of mean log frequencies between texts, at least
FEW = 30                     # texts that tell little of how texts differ
UNUSUAL = 22.0               # standard deviations below which a text is not of its language

_SPACED = np.arange(256, dtype=np.uint32)
_SPACED[:128] = 32
_SPACED[97:123] = np.arange(97, 123)


@dataclass(frozen=True)
class LanguageModel:
    """``machines[k]`` is ``(one side, other side)``: family names (other side empty) or languages."""

    families: Mapping[str, tuple[str, ...]]
    machines: tuple[tuple[str, str], ...]
    weights: np.ndarray   # one column per machine, and a last row of zeros
    biases: np.ndarray
    scales: np.ndarray
    langs: tuple[str, ...] = ()
    usual: np.ndarray | None = None    # log frequencies, one column per language, and a last row of zeros
    spread: np.ndarray | None = None   # per language: mean log frequency, its deviation between texts and inside one


def _grams(data: np.ndarray, lo: int, hi: int, row_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3- and 4-grams that start at bytes ``lo:hi``; ``SIZE`` where there is none."""
    b = np.full(hi - lo + 3, 32, np.uint32)
    part = data[lo:hi + 3]
    b[:len(part)] = _SPACED[part]
    three = b[:-3] | (b[1:-2] << np.uint32(8)) | (b[2:-1] << np.uint32(16))
    four = three | (b[3:] << np.uint32(24))
    shift = np.uint32(32 - HASH_BITS)
    i3 = ((three * np.uint32(0x9E3779B1)) >> shift).astype(np.int32)
    i4 = ((four * np.uint32(0x85EBCA6B)) >> shift).astype(np.int32) + (1 << HASH_BITS)
    gap = b[1:-2] == 32
    i3[gap] = SIZE
    i4[gap | (b[2:-1] == 32)] = SIZE
    for back in (1, 2, 3):  # n-grams do not reach into the next text
        at = row_ends - back - lo
        at = at[(at >= 0) & (at < hi - lo)]
        i4[at] = SIZE
        if back < 3:
            i3[at] = SIZE
    return i3, i4


def _means(column: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean weights over the n-grams of every text, and the number of n-grams."""
    data, at = flat(column)
    n = len(at) - 1
    total, count = np.zeros((n, weights.shape[1])), np.zeros(n)
    known = np.ones(SIZE + 1)
    known[SIZE] = 0
    for lo, hi, i, j in byte_slices(at):
        i3, i4 = _grams(data, lo, hi, at[i + 1:j + 1])
        starts = np.clip(at[i:j] - lo, 0, hi - lo)
        ends = np.clip(at[i + 1:j + 1] - lo, 0, hi - lo)
        count[i:j] += sums(known[i3] + known[i4], starts, ends)
        for k in range(weights.shape[1]):
            w = np.ascontiguousarray(weights[:, k])
            total[i:j, k] += sums(w[i3] + w[i4], starts, ends)
    return total / np.maximum(count, 1)[:, None], count


def _profiles(df: DataFrame) -> DataFrame:
    """``(lang, key, buckets, shares, grams)``: n-gram frequencies of the texts of a sample, and how
    many n-grams they have."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, at = flat(batch.column(2))
        buckets, shares, grams = [], [], []
        for i in range(batch.num_rows):
            counts = np.zeros(SIZE + 1)
            for lo, hi, _, _ in byte_slices(at[i:i + 2]):
                for g in _grams(data, lo, hi, at[i + 1:i + 2]):
                    counts += np.bincount(g, minlength=SIZE + 1)
            some = np.flatnonzero(counts[:SIZE])
            buckets.append(some.astype(np.int32))
            grams.append(int(counts[:SIZE].sum()))
            shares.append(counts[some] / max(grams[-1], 1))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(buckets, pa.list_(pa.int32())),
             pa.array(shares, pa.list_(pa.float64())), pa.array(grams, pa.int64())],
            ["lang", "key", "buckets", "shares", "grams"],
        )

    return map_batches(df, run, [
        T.StructField("lang", T.StringType()), T.StructField("key", T.LongType()),
        T.StructField("buckets", T.ArrayType(T.IntegerType())), T.StructField("shares", T.ArrayType(T.DoubleType())),
        T.StructField("grams", T.LongType()),
    ])


def _fit_machine(rows: pd.DataFrame) -> pd.DataFrame:
    """A linear machine with squared hinge loss, both sides weighted alike."""
    rows = rows.sort_values(["side", "lang", "key"], kind="stable")
    lengths = rows["buckets"].map(len).to_numpy()
    ends = np.cumsum(lengths)
    starts = ends - lengths
    at = np.concatenate(rows["buckets"].to_list()).astype(np.int64)
    x = np.concatenate(rows["shares"].to_list())
    unit = np.sqrt(np.mean(sums(x * x, starts, ends))) or 1.0
    x = x / unit
    row_of = np.repeat(np.arange(len(rows)), lengths)
    y = rows["side"].to_numpy().astype(float)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    step = 1 / (2 * (1 + 1) * 4)
    w, bias = np.zeros(SIZE), 0.0
    ahead, bias_ahead = w, bias
    for t in range(STEPS):
        slack = np.maximum(0, 1 - y * (sums(x * ahead[at], starts, ends) + bias_ahead))
        pull = -2 * share * y * slack
        new = ahead - step * (np.bincount(at, x * pull[row_of], SIZE) + PENALTY * ahead)
        new_bias = bias_ahead - step * pull.sum()
        keep = t / (t + 3)
        ahead, bias_ahead = new + keep * (new - w), new_bias + keep * (new_bias - bias)
        w, bias = new, new_bias
    margins = np.abs(sums(x * w[at], starts, ends) + bias)
    return pd.DataFrame({
        "machine": [rows["machine"].iloc[0]], "weights": [w / unit], "bias": [bias],
        "scale": [3 / max(float(np.median(margins)), 1e-6)],
    })


def _fit_usual(rows: pd.DataFrame) -> pd.DataFrame:
    """Log frequencies of a language's n-grams from two thirds of its texts, and what they come to in
    the others."""
    rows = rows[rows["grams"] > 0].sort_values("key", kind="stable")
    apart = np.arange(len(rows)) % 3 == 0
    if len(rows) < 6:
        apart[:] = False
    total = np.zeros(SIZE)
    for buckets, shares in zip(rows["buckets"][~apart], rows["shares"][~apart]):
        total[np.asarray(buckets, np.int64)] += shares
    usual = np.log(total / max((~apart).sum(), 1) + RARE)
    judged = rows[apart] if apart.any() else rows
    means, inner, grams = [], [], judged["grams"].to_numpy()
    for buckets, shares in zip(judged["buckets"], judged["shares"]):
        x = usual[np.asarray(buckets, np.int64)]
        means.append(float(np.dot(x, shares)))
        inner.append(float(np.dot((x - means[-1]) ** 2, shares)))
    means, inner = np.array(means), np.array(inner)
    some = grams >= np.median(grams) if len(grams) else np.zeros(0, bool)  # the longer half tells how texts differ
    centre = float(np.median(means[some])) if len(means) else 0.0
    between = 1.4826 * float(np.median(np.abs(means[some] - centre))) if len(means) else 1.0
    inside = float(np.sqrt(np.mean(inner))) if len(inner) else 1.0
    return pd.DataFrame({
        "lang": [rows["lang"].iloc[0] if len(rows) else None], "usual": [usual], "centre": [centre],
        "between": [max(between, LEAST_SPREAD) * (1 + FEW / max(len(judged), 1))], "inside": [max(inside, LEAST_SPREAD)],
    })


def _text(text_col: str) -> tuple[Column, Column]:
    text = F.col(f"`{text_col}`")
    return F.lower(text), F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit_language_model(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", family_of: Mapping[str, str] = FAMILY_OF,
    sample: int = SAMPLE,
) -> LanguageModel:
    """Fit on about ``sample`` different texts per language (chosen by a hash of the text).

    Rows without a language or without a letter are not used; equal texts of one language
    count once; other columns are ignored.  Without any usable row the model knows no
    language.  Each machine is fitted in one task on at most ``sample`` texts per language.
    """
    spark = docs.sparkSession
    lower, lettered = _text(text_col)
    rows = docs.select(F.col(f"`{lang_col}`").alias("lang"), lower.alias("text"), lettered.alias("has"))
    counts = {r["lang"]: r["count"] for r in rows.where("lang is not null").groupBy("lang").count().collect()}
    langs = sorted(counts)
    families: dict[str, tuple[str, ...]] = {}
    for lang in langs:
        name = family_of.get(lang, lang)
        families[name] = (*families.get(name, ()), lang)
    machines, sides = [], []
    if len(families) > 1:
        for name, members in families.items():
            sides += [(len(machines), lang, 1 if lang in members else -1) for lang in langs]
            machines.append((name, ""))
    for members in families.values():
        for a, b in combinations(members, 2):
            sides += [(len(machines), a, 1), (len(machines), b, -1)]
            machines.append((a, b))
    weights = np.zeros((SIZE + 1, len(machines)))
    biases, scales = np.zeros(len(machines)), np.ones(len(machines))
    usual, spread = np.zeros((SIZE + 1, len(langs))), np.tile([0.0, np.inf, 1.0], (len(langs), 1))
    if langs:
        limit = 1 << 30
        rates = spark.createDataFrame(
            [(lang, int(min(1.0, sample / n) * limit)) for lang, n in counts.items()], "lang string, rate long"
        )
        chosen = (
            rows.where("has and lang is not null").withColumn("key", F.xxhash64("text"))
            .join(F.broadcast(rates), "lang").where(F.pmod("key", F.lit(limit)) < F.col("rate"))
            .groupBy("lang", "key").agg(F.first("text").alias("text"))
        )
        profiles = durable(_profiles(chosen.select("lang", "key", "text")), "language-profiles")
        counted = profiles.groupBy("lang").applyInPandas(
            _fit_usual, "lang string, usual array<double>, centre double, between double, inside double"
        )
        for r in counted.where("lang is not null").collect():  # one row of SIZE numbers per language
            k = langs.index(r["lang"])
            usual[:SIZE, k], spread[k] = r["usual"], (r["centre"], r["between"], r["inside"])
    if machines:
        table = spark.createDataFrame(sides, "machine int, lang string, side int")
        fitted = (
            profiles.join(F.broadcast(table), "lang").groupBy("machine")
            .applyInPandas(_fit_machine, "machine int, weights array<double>, bias double, scale double")
        )
        for r in fitted.collect():  # one row of SIZE numbers per machine
            weights[:SIZE, r["machine"]] = r["weights"]
            biases[r["machine"]], scales[r["machine"]] = r["bias"], r["scale"]
    return LanguageModel(families, tuple(machines), weights, biases, scales, tuple(langs), usual, spread)


def _decide(model: LanguageModel, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The predicted language and its score, by rows."""
    n = len(margins)
    margins = margins * model.scales
    names = list(model.families)
    first = [model.machines.index((f, "")) for f in names] if len(names) > 1 else []
    odds = np.exp(np.clip(margins[:, first], -30, 30)) if first else np.ones((n, 1))
    odds = odds / odds.sum(axis=1, keepdims=True)
    family = odds.argmax(axis=1)
    lang, score = np.empty(n, object), odds.max(axis=1)
    for k, name in enumerate(names):
        rows = np.flatnonzero(family == k)
        members = model.families[name]
        votes, wins = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
        for a, b in combinations(range(len(members)), 2):
            m = margins[rows, model.machines.index((members[a], members[b]))]
            p = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
            votes[:, a] += m >= 0
            votes[:, b] += m < 0
            wins[:, a] += p
            wins[:, b] += 1 - p
        best = (votes * (len(members) + 1) + wins).argmax(axis=1)
        lang[rows] = np.array(members, object)[best]
        if len(members) > 1:
            score[rows] *= wins[np.arange(len(rows)), best] / (len(members) - 1)
    return lang, score


def identify_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id_col, lang_pred, score, usual)`` for every row of ``docs``; ``usual`` tells how many standard
    deviations the text lies from the labelled ones of the language, below zero if its n-grams
    are rarer.

    A null text, a text without any letter and every text under a model that knows no
    language get ``und``, score 0 and no ``usual``.  A text too short for an n-gram goes by the
    machines' biases.  Repeated rows and null ids each give a row of their own; other
    columns are ignored, whatever their names.
    """
    lower, lettered = _text(text_col)
    # plain values: a broadcast is unpickled before any function of this package is there
    shipped = docs.sparkSession.sparkContext.broadcast(
        (dict(model.families), model.machines, model.weights, model.biases, model.scales, model.langs, model.usual, model.spread)
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = LanguageModel(*shipped.value)
        n = batch.num_rows
        lang, score, usual = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan)
        has = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
        if known.families and len(has):
            texts = pc.take(pc.fill_null(batch.column(1), "").cast(pa.large_string()), pa.array(has))
            means, grams = _means(texts, np.concatenate([known.weights, known.usual], axis=1))
            k = len(known.machines)
            lang[has], score[has] = _decide(known, means[:, :k] + known.biases)
            found = np.array([known.langs.index(x) for x in lang[has]])
            centre, between, inside = known.spread[found].T
            off = means[np.arange(len(has)), k + found] - centre
            usual[has] = off / np.sqrt(between**2 + OVERLAP * inside**2 / np.maximum(grams, 1))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(usual, mask=np.isnan(usual))],
            [id_col, "lang_pred", "score", "usual"],
        )

    return map_batches(
        docs.select(F.col(f"`{id_col}`").alias("id"), lower.alias("text"), lettered.alias("has")), run,
        [field(docs, id_col), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
         T.StructField("usual", T.DoubleType())],
    )


def with_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", unusual: float = UNUSUAL
) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: those that would get ``und``, and those
    more than ``unusual`` standard deviations below the labelled texts of the language they are
    nearest to.  Rows equal in id and text share their fate."""
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    found = identify_language(docs.select(key.alias("key"), F.col(f"`{text_col}`").alias("text")), model, "key", "text")
    rejected = durable(found.where((F.col("lang_pred") == UNKNOWN) | (F.col("usual") < -unusual)).select("key").distinct(), "no-language")
    return docs.join(rejected, F.xxhash64(docs[f"`{id_col}`"], docs[f"`{text_col}`"]) == rejected["key"], "left_anti")
