"""Array and map expressions: scores, fixed-length token rows, label lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

IGNORED_LABEL = -100  # fixed value: positions a causal loss must skip


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind ``value`` once, so that a lambda does not compute it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def softmax(scores: Column | str) -> Column:
    s = _col(scores).cast("array<double>")
    powers = let(F.array_max(s), lambda m: F.transform(s, lambda x: F.exp(x - m)))
    return let(
        powers,
        lambda p: let(
            F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x),
            lambda total: F.transform(p, lambda x: x / total),
        ),
    )


def top1(scores: Column | str) -> Column:
    """Position of the largest score, counted from 0; the first one on a tie."""
    s = _col(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def label_of(class_id: Column | str, id2label: Mapping[int, str]) -> Column:
    """Class name from a fixed dictionary; null for an unknown id."""
    pairs = [F.lit(x) for kv in sorted(id2label.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(class_id).cast("int"))


def truncate(ids: Column | str, max_len: int = 256) -> Column:
    return F.slice(_col(ids), 1, max_len)


def pad_right(ids: Column | str, pad_id: int, max_len: int = 256) -> Column:
    a = truncate(ids, max_len)
    return F.concat(a, F.array_repeat(F.lit(pad_id), F.lit(max_len) - F.size(a)))


def attention_mask(ids: Column | str, max_len: int = 256) -> Column:
    n = F.least(F.size(_col(ids)), F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))


def clm_labels(ids: Column | str, pad_id: int) -> Column:
    """Labels of a causal model: the ids themselves, padding masked out."""
    return F.transform(
        _col(ids), lambda x: F.when(x == pad_id, F.lit(IGNORED_LABEL)).otherwise(x)
    )
