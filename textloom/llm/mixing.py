"""Mixing towards target weights with soft membership.

A naive Bayes classifier, fitted on a labelled table, gives every document posteriors over
domains.  Nonnegative document rates are then fitted so that the expected tokens of every
domain (tokens x posterior x rate, summed) match the targets: projected-gradient least
squares, in which every step is one aggregate of as many numbers as there are domains.
The metric of the steps is the inverse of the domains' token Gram matrix, so without
active bounds one step solves the problem.  A rate depends on a document's posteriors
alone; it is a column expression, and no document is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from textloom.plans import durable

BUCKETS = 4096          # hashed words
LABELLED = 20_000       # labelled rows that a classifier is fitted on, about; they are broadcast
EVIDENCE = 32           # words' worth of evidence in a text, at most: keeps memberships soft
STEPS, CLOSE = 30, 1e-4  # of the solver; relative distance to the targets at which it stops
_SCALE = 1_000_000      # weights are whole millionths, so sums do not depend on order


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    priors: tuple[float, ...]              # logarithms
    weights: tuple[tuple[int, ...], ...]   # by domain and bucket


@dataclass(frozen=True)
class Mix:
    """``rate = max(least, rate - posteriors . step)`` over all steps, starting at 1."""

    model: DomainModel
    steps: tuple[tuple[float, ...], ...]
    least: float
    expected: dict[str, float]   # tokens by domain under the rates
    targets: dict[str, float]


def _words(text_col: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), r"\s+"), "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit_domain_model(
    docs: DataFrame, labels: DataFrame, domain: Column, id_col: str = "doc_id", text_col: str = "text",
    label_id_col: str = "doc_id", labelled: int = LABELLED,
) -> DomainModel:
    """Fit on about ``labelled`` rows of ``labels``, chosen by a hash of their id.

    ``domain`` is an expression over ``labels``; rows without an id or domain are not used,
    and of several domains for one id the first in order counts.  No labelled row gives a
    model of no domain.
    """
    known = labels.select(F.col(f"`{label_id_col}`").alias("id"), domain.cast("string").alias("domain")).where(
        "id is not null and domain is not null"
    ).groupBy("id").agg(F.min("domain").alias("domain"))
    total = known.count()
    limit = 1 << 30
    rate = int(min(1.0, labelled / max(total, 1)) * limit)
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(limit)) < rate)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), _words(text_col).alias("words")).join(F.broadcast(chosen), "id")
    counts = rows.select("domain", F.explode("words").alias("w")).groupBy("domain", _bucket(F.col("w")).alias("b")).count()
    seen: dict[str, list[int]] = {}
    for r in counts.collect():  # one number per domain and bucket
        seen.setdefault(r["domain"], [0] * BUCKETS)[r["b"]] = r["count"]
    sizes = {r["domain"]: r["count"] for r in chosen.groupBy("domain").count().collect()}
    names = sorted(seen)
    n = sum(sizes[d] for d in names)
    logs = [[math.log((c + 0.5) / (sum(seen[d]) + 0.5 * BUCKETS)) for c in seen[d]] for d in names]
    mean = [sum(col) / len(names) for col in zip(*logs)]
    return DomainModel(
        tuple(names), tuple(math.log(sizes[d] / n) for d in names),
        tuple(tuple(round((x - m) * _SCALE) for x, m in zip(row, mean)) for row in logs),
    )


def _adding(table: Column):
    return lambda total, at: total + F.get(table, at)


def _profiled(df: DataFrame, model: DomainModel, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep``, ``t`` (words) and ``p`` (posteriors).  A generator of one row is a barrier: the
    words are split once, whatever is computed from them."""
    words = df.select(*keep, F.inline(F.array(F.struct(F.transform(_words(text_col), _bucket).alias("b")))))
    cols = [c for c in words.columns if c != "b"]
    sums = []
    for k, weights in enumerate(model.weights):
        table = F.expr(f"cast(split('{','.join(map(str, weights))}', ',') as array<bigint>)")
        total = F.aggregate("b", F.lit(0).cast("long"), _adding(table))
        share = F.least(F.size("b"), F.lit(EVIDENCE)) / F.greatest(F.size("b"), F.lit(1)) / _SCALE
        sums.append((F.lit(model.priors[k]) + total * share).alias(f"z{k}"))
    odds = words.select(*cols, F.inline(F.array(F.struct(F.size("b").cast("long").alias("t"), *sums))))
    z = [F.col(f"z{k}") for k in range(len(sums))]
    top = F.greatest(*z) if len(z) > 1 else z[0]
    e = odds.select(*cols, "t", F.transform(F.array(*z), lambda x: F.exp(x - top)).alias("e"))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return e.select(*cols, "t", F.transform("e", lambda x: x / total).alias("p"))


def _rate(p: Column, steps, least: float) -> Column:
    rate = F.lit(1.0) if least <= 1 else F.lit(float(least))
    for step in steps:
        moved = rate
        for k, y in enumerate(step):
            moved = moved - F.get(p, F.lit(k)) * F.lit(y)
        rate = F.greatest(F.lit(float(least)), moved)
    return rate


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """A small symmetric system, by elimination; the diagonal is raised a little."""
    n = len(right)
    ridge = 1e-9 * max(matrix[k][k] for k in range(n)) or 1.0
    rows = [[*matrix[i], right[i]] for i in range(n)]
    for i in range(n):
        rows[i][i] += ridge
    for i in range(n):
        best = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[best] = rows[best], rows[i]
        for r in range(n):
            if r != i:
                f = rows[r][i] / rows[i][i]
                rows[r] = [a - f * b for a, b in zip(rows[r], rows[i])]
    return [rows[i][n] / rows[i][i] for i in range(n)]


def fit_mix(
    docs: DataFrame, model: DomainModel, weights: Mapping[str, float], text_col: str = "text", least: float = 0.0,
    tokens: float | None = None,
) -> Mix:
    """Rates under which the domains' expected tokens stand in the proportions ``weights``.

    ``tokens`` is the sum of all targets; by default that of the corpus, and with a
    ``least`` rate above 0 the smallest sum for which no domain has to shrink.  Domains of
    the model that ``weights`` leaves out get 0.  Targets that no rates reach are
    approached as far as the bounds allow.
    """
    k = len(model.domains)
    if not k:
        return Mix(model, (), least, {}, {})
    profiles = durable(_profiled(docs, model, text_col, []), "profiles")
    p = [F.get("p", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = profiles.agg(
        *[F.sum(F.col("t") * p[i] * p[j]).alias(f"m{i}_{j}") for i, j in pairs],
        *[F.sum(F.col("t") * p[i]).alias(f"n{i}") for i in range(k)],
    ).first()
    natural = [got[f"n{i}"] or 0.0 for i in range(k)]
    gram = [[got[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]
    share = [max(float(weights.get(d, 0.0)), 0.0) for d in model.domains]
    whole = sum(natural)
    if not whole or not sum(share):
        return Mix(model, (), least, dict(zip(model.domains, natural)), {})
    share = [s / sum(share) for s in share]
    if tokens is None:
        tokens = max([whole, *(n * least / s for n, s in zip(natural, share) if s)]) if least else whole
    targets = [s * tokens for s in share]
    steps: list[tuple[float, ...]] = []
    best: tuple[float, int, list[float]] | None = None
    for _ in range(STEPS + 1):
        rate = _rate(F.col("p"), steps, least)
        now = profiles.agg(*[F.sum(F.col("t") * p[i] * rate).alias(f"a{i}") for i in range(k)]).first()
        reached = [now[f"a{i}"] for i in range(k)]
        off = sum(abs(a - b) for a, b in zip(reached, targets)) / tokens
        if best is None or off < best[0]:
            best = (off, len(steps), reached)
        if off < CLOSE or len(steps) == STEPS:
            break
        steps.append(tuple(_solve(gram, [a - b for a, b in zip(reached, targets)])))
    return Mix(
        model, tuple(steps[:best[1]]), least, dict(zip(model.domains, best[2])), dict(zip(model.domains, targets))
    )


def _epochs(rate: Column, *key: Column) -> Column:
    """Whole copies: the rate's whole part, and one more with the chance of its fraction,
    by a hash of the row."""
    dice = F.pmod(F.xxhash64(*key), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate + dice).cast("int")


def document_rates(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, domain, posterior, rate, epochs)`` for every row of ``docs``.

    ``domain`` is the likeliest (the first of equals), ``n_tokens`` the words of the text.
    Null and empty texts have no words and the prior's posteriors.  Rows equal in id and
    text get equal values.  Without domains every rate is 1 and the domain is null.  Other
    columns are ignored.
    """
    ident, text = F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h")
    if not mix.model.domains:
        return docs.select(
            F.col(f"`{id_col}`"), F.size(_words(text_col)).cast("long").alias("n_tokens"),
            F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("posterior"),
            F.lit(1.0).alias("rate"), F.lit(1).alias("epochs"),
        )
    rows = _profiled(docs, mix.model, text_col, [ident, text])
    names = F.array(*[F.lit(d) for d in mix.model.domains])
    rate = _rate(F.col("p"), mix.steps, mix.least)
    return rows.withColumn("r", rate).select(
        F.col("id").alias(id_col), F.col("t").alias("n_tokens"),
        F.get(names, (F.array_position("p", F.array_max("p")) - 1).cast("int")).alias("domain"),
        F.array_max("p").alias("posterior"), F.col("r").alias("rate"), _epochs(F.col("r"), F.col("h")).alias("epochs"),
    )


def mixed(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every row as often as its epochs say, in the same columns."""
    if not mix.model.domains:
        return docs
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("h")
    rows = _profiled(docs, mix.model, text_col, [whole, key])
    epochs = _epochs(_rate(F.col("p"), mix.steps, mix.least), F.col("h"))
    copies = rows.select("row", F.explode(F.array_repeat(F.lit(0), epochs)).alias("copy"))
    return copies.select(*[F.col("row")[c].alias(c) for c in docs.columns])
