"""The whole corpus job, with one status per document."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from textloom.functions.arrays import label_of, top1
from textloom.operators.dedup import duplicate_clusters
from textloom.operators.heuristics import Recipe, heur_stats, passes
from textloom.operators.scorers import NaiveBayes, Scorer, probabilities, quality_pass, raw_joined
from textloom.operators.tokens import token_counter
from textloom.plans.barrier import computed
from textloom.plans.checks import require_absent, require_columns
from textloom.plans.lineage import durable

STAGES = ("heuristic", "quality", "toxic", "duplicate")  # in the order in which they run


@dataclass(frozen=True)
class CorpusConfig:
    recipe: Recipe
    quality: Scorer
    toxic: Scorer
    domain: Scorer
    id2label: Mapping[int, str]
    quality_target: int = 1
    quality_threshold: float = 0.5
    dedup: Mapping = field(default_factory=dict)
    tokenizer: str | Callable = "words"


def _scored(df: DataFrame, scorers: Mapping[str, Scorer], alive, text_col: str, id_col: str) -> DataFrame:
    """Scores of several models for living rows only: a scorer skips null texts.  All models
    that are shipped to the workers score in one pass over the texts, and so do all that are joined."""
    bayes = {n: s for n, s in scorers.items() if isinstance(s, NaiveBayes)}
    joined, at_once = ({n: s for n, s in bayes.items() if s.in_place == shipped} for shipped in (False, True))
    fed = df
    if joined:
        fed = raw_joined(fed.withColumn("__alive", alive), joined, text_col, "__alive").drop("__alive")
    fed = fed.withColumn("__fed", F.when(alive, F.col(text_col)))
    if at_once:
        fed = computed(fed, {n: s.raw_column(F.col("__fed")) for n, s in at_once.items()})
    fed = fed.withColumns({n: probabilities(n) for n in bayes}) if bayes else fed
    for name, scorer in scorers.items():
        if name not in bayes:
            fed = scorer(fed, "__fed", id_col).withColumnRenamed("scores", name)
    return fed.drop("__fed")


def clean_corpus(
    df: DataFrame, config: CorpusConfig, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``df`` with ``status`` (the first stage that rejected the row, or ``kept``) and, for
    kept rows, ``domains`` and ``n_tokens``.

    The row-wise stages run in one pass whose result is stored once; only survivors are
    compared with each other, and only kept rows are tagged and counted.  A domain model that is
    Naive Bayes runs in that pass too, as it needs no more than the words the others look up.
    """
    require_columns(df, id_col, text_col)
    require_absent(df, "status", "domains", "n_tokens")
    names = list(dict.fromkeys(b[0] for b in config.recipe.bounds))
    stats = heur_stats(df, names, config.recipe, text_col) if names else df
    keep = passes(config.recipe) & F.col(text_col).isNotNull()
    if config.recipe.languages is not None:
        keep = keep & F.coalesce(F.col(lang_col).isin(sorted(config.recipe.languages)), F.lit(False))
    rows = stats.withColumn("__ok", keep)
    models = {"__q": config.quality, "__x": config.toxic}
    early = isinstance(config.domain, NaiveBayes)
    rows = _scored(rows, models | ({"__d": config.domain} if early else {}), F.col("__ok"), text_col, id_col)
    status = (
        F.when(~F.col("__ok"), "heuristic")
        .when(~quality_pass("__q", config.quality_target, config.quality_threshold), "quality")
        .when(top1("__x") != 0, "toxic")
    )
    domain = label_of(top1("__d"), config.id2label).alias("domains")
    judged = durable(rows.select(*df.columns, *([domain] if early else []), status.alias("status")), "judged")
    alive = judged.where("status is null").drop("status")
    clusters = duplicate_clusters(alive, id_col=id_col, text_col=text_col, **config.dedup)
    losers = durable(
        clusters.where(F.col(id_col) != F.col("cluster")).select(id_col, F.lit("duplicate").alias("__dup")), "losers"
    )
    # only rows that are still alive take part in the join; built-in counts are made before it, so
    # that it moves no text for them, and what costs more is done for kept rows alone
    count = token_counter(config.tokenizer)(F.col(text_col))
    counted = alive if callable(config.tokenizer) else computed(alive, {"__n": count})
    final = counted.join(losers, id_col, "left").withColumn("status", F.coalesce("__dup", F.lit("kept"))).drop("__dup")
    kept = F.col("status") == "kept"
    if not early:
        final = _scored(final, {"__d": config.domain}, kept, text_col, id_col).withColumn("domains", domain)
    tagged = final.select(
        *df.columns, "status", F.when(kept, F.col("domains")).alias("domains"),
        F.when(kept, count if callable(config.tokenizer) else F.col("__n")).alias("n_tokens"),
    )
    gone = judged.where("status is not null").select(*df.columns, "status")
    return tagged.unionByName(gone.withColumns({
        c: F.lit(None).cast(tagged.schema[c].dataType) for c in ("domains", "n_tokens")
    }))


def funnel(df: DataFrame) -> DataFrame:
    """``(step, stage, rows_in, rows_out)`` for every stage, from one grouped count."""
    require_columns(df, "status")
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("status") == s).alias(s) for s in STAGES]
    )
    rows, gone = [], F.lit(0).cast("long")
    for i, s in enumerate(STAGES):
        rows.append(F.struct(
            F.lit(i + 1).alias("step"), F.lit(s).alias("stage"),
            (F.col("n") - gone).alias("rows_in"), (F.col("n") - gone - F.col(s)).alias("rows_out"),
        ))
        gone = gone + F.col(s)
    return counts.select(F.inline(F.array(*rows)))
