"""Recipe-driven heuristic filter: statistics per document, then one predicate.

Every rule looks at one row only, so a recipe of any length is one scan without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from textloom.functions.text import WS_CHARS, words
from textloom.plans.checks import require_absent, require_columns
from textloom.plans.barrier import computed
from textloom.plans.lexicon import row_parts, text_parts, word_lists


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _letters_and_digits(t: Column) -> Column:
    return F.char_length(F.regexp_replace(t, r"[^\p{L}\p{N}]+", ""))


def _special(t: Column) -> Column:
    return F.char_length(F.regexp_replace(t, rf"[\p{{L}}\p{{N}}{WS_CHARS}]+", ""))


def _share(owner: np.ndarray, gram: np.ndarray, rows: int) -> np.ndarray:
    """Per row, the share of its n-grams that occur more than once in it."""
    order = np.lexsort((gram, owner))
    owner, gram = owner[order], gram[order]
    new = np.ones(len(gram) + 1, bool)
    new[1:-1] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    edges = np.flatnonzero(new)
    counts = np.diff(edges)
    several = np.where(counts > 1, counts, 0)
    total = np.bincount(owner[edges[:-1]], counts, rows)
    return np.bincount(owner[edges[:-1]], several, rows) / np.maximum(total, 1)


def _grams(items: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``n`` items of a row."""
    counts = np.maximum(np.diff(offsets) - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(offsets[:-1], counts)
    gram = np.zeros(len(first), np.uint64)
    for j in range(n):
        gram = (gram ^ items[first + j]) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
    return owner, gram


def _repeated_share(text: Column, n: int, of_words: bool) -> Column:
    """Share of the n-grams that occur more than once in their document.

    An Arrow function: n-grams stay within their row, so grouping them needs no shuffle.
    It hashes and sorts the n-grams of many rows at once, but of a slice of a batch only, as they
    take many times the room of their texts.
    """

    def shares(items: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        parts = [
            _share(*_grams(items[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n), j - i)
            for i, j in row_parts(offsets)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)

    @F.arrow_udf("double")
    def by_words(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in chain.from_iterable(map(text_parts, parts)):
            found, offsets, valid = word_lists(texts)
            coded = found.dictionary_encode()
            names = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), object)) if len(found) else np.zeros(0, np.uint64)
            yield pa.array(shares(names[coded.indices.to_numpy(zero_copy_only=False)], offsets), mask=~valid)

    @F.arrow_udf("double")
    def by_chars(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in chain.from_iterable(map(text_parts, parts)):
            valid = texts.is_valid().to_numpy(zero_copy_only=False)
            filled = pc.fill_null(texts, "")
            points = np.frombuffer("".join(filled.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
            sizes = pc.utf8_length(filled).to_numpy(zero_copy_only=False)
            yield pa.array(shares(points.astype(np.uint64) + np.uint64(1), np.concatenate([[0], np.cumsum(sizes)])), mask=~valid)

    return by_words(text) if of_words else by_chars(text)


def listed_share(w: Column, listed: Collection[str]) -> Column:
    """Share of words on a list.  The list is a recipe parameter, not data."""
    known = sorted(set(listed))
    return _ratio(F.size(F.filter(w, lambda x: x.isin(known))), F.size(w))


# Each rule maps (text, words, lines) to its statistic.
RULES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "text_length": lambda t, w, l: F.char_length(t),
    "word_count": lambda t, w, l: F.size(w),
    "alnum_ratio": lambda t, w, l: _ratio(_letters_and_digits(t), F.char_length(t)),
    "special_ratio": lambda t, w, l: _ratio(_special(t), F.char_length(t)),
    "mean_line_length": lambda t, w, l: _ratio(
        F.char_length(F.replace(t, F.lit("\n"), F.lit(""))), F.size(l)
    ),
    "max_line_length": lambda t, w, l: F.array_max(F.transform(l, F.char_length)),
    "repeated_line_ratio": lambda t, w, l: F.lit(1.0) - F.size(F.array_distinct(l)) / F.size(l),
}


# The rules that look at words and lines; neither is cut for the others.
OF_WORDS = {"word_count", "stop_word_ratio", "flagged_word_ratio"}
OF_LINES = {"mean_line_length", "max_line_length", "repeated_line_ratio"}


@dataclass(frozen=True)
class Recipe:
    """Ordered bounds ``(rule, min, max)``; ``None`` leaves a side open."""

    bounds: Sequence[tuple[str, float | None, float | None]] = ()
    word_gram: int = 10
    char_gram: int = 10
    stop_words: Collection[str] = field(default_factory=tuple)
    flagged_words: Collection[str] = field(default_factory=tuple)
    languages: Collection[str] | None = None

    def rule(self, name: str) -> Callable[[Column, Column, Column], Column]:
        extra = {
            "word_repetition": lambda t, w, l: _repeated_share(t, self.word_gram, True),
            "char_repetition": lambda t, w, l: _repeated_share(t, self.char_gram, False),
            "stop_word_ratio": lambda t, w, l: listed_share(w, self.stop_words),
            "flagged_word_ratio": lambda t, w, l: listed_share(w, self.flagged_words),
        }
        found = RULES.get(name) or extra.get(name)
        if found is None:
            raise ValueError(f"unknown rule {name!r}; known: {sorted([*RULES, *extra])}")
        return found


def heur_stats(
    df: DataFrame, rules: Sequence[str] | None = None, recipe: Recipe = Recipe(), text_col: str = "text"
) -> DataFrame:
    """``df`` with one column per rule."""
    names = list(rules or RULES)
    require_columns(df, text_col)
    require_absent(df, *names)
    t = F.col(text_col)
    parts = {"__w": (words(t), OF_WORDS), "__l": (F.split(t, "\n"), OF_LINES)}
    used = {c: value for c, (value, rules_of) in parts.items() if rules_of & set(names)}
    wide = computed(df, used) if used else df
    return computed(wide, {n: recipe.rule(n)(t, F.col("__w"), F.col("__l")) for n in names}, df.columns)


def passes(recipe: Recipe) -> Column:
    """One predicate over the statistics; a null statistic does not pass."""
    keep = F.lit(True)
    for name, low, high in recipe.bounds:
        c = F.col(name)
        if low is not None:
            keep = keep & (c >= low)
        if high is not None:
            keep = keep & (c <= high)
    return F.coalesce(keep, F.lit(False))


def heur_filter(
    df: DataFrame, recipe: Recipe, text_col: str = "text", lang_col: str = "lang", keep_stats: bool = False
) -> DataFrame:
    """Rows within all bounds of the recipe.  The language list is tested on the
    stored column first, where it can reach the scan."""
    rows = df
    if recipe.languages is not None:
        require_columns(df, lang_col)
        rows = df.where(F.col(lang_col).isin(sorted(recipe.languages)))
    names = list(dict.fromkeys(b[0] for b in recipe.bounds))
    if not names:
        return rows
    kept = heur_stats(rows, names, recipe, text_col).where(passes(recipe))
    return kept if keep_stats else kept.select(*df.columns)
