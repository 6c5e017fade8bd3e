"""Turning words into numbers through a table with one row per word.

A table of at most ``MAX_BROADCAST_WORDS`` rows (checked) is shipped once to every
worker, and documents are mapped where they lie: no shuffle.  For a larger table the
documents are stored in chunks of about ``CHUNK_BYTES`` of text; only the distinct words of
every chunk are joined with the table, and what they find goes to the chunk's documents.  So
no row is shuffled for a word that its chunk has already.  A result depends on the text
alone in both ways, whatever the rows' ids.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from textloom.functions.text import words
from textloom.plans.checks import require_absent
from textloom.plans.lineage import durable

MAX_BROADCAST_WORDS = 500_000
MAX_BROADCAST_BYTES = 64 << 20
CHUNK_BYTES = 16 << 20  # text of a chunk; one document at least
SLICE_BYTES = 4 << 20   # text that is cut into words at once; one row at least
_WORDS_AT_ONCE = 1 << 20
_CHUNK_BITS = 33        # chunks of a task are numbered below this bit


def within_limits(rows: int, word_bytes: int, width: int) -> bool:
    return rows <= MAX_BROADCAST_WORDS and word_bytes + rows * width * 8 <= MAX_BROADCAST_BYTES


def fits_broadcast(table: DataFrame, word_col: str = "word", width: int = 1) -> bool:
    """Whether the table's words and numbers stay within both limits."""
    n, size = table.agg(F.count(F.lit(1)), F.sum(F.octet_length(word_col))).first()
    return within_limits(n, size or 0, width)


def ship(table: DataFrame, word_col: str, value_cols: Sequence[str]):
    """Broadcast ``word -> position`` and the matrix of values, one row per position."""
    cols = table.select(word_col, *value_cols).toArrow()
    position = {w: i for i, w in enumerate(cols[word_col].to_pylist())}
    values = np.column_stack([cols[c].to_numpy() for c in value_cols]).astype(np.int64)
    return table.sparkSession.sparkContext.broadcast((position, values))


def flat_lists(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(items, offsets, valid)`` of a list column; a null list has no items."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.concatenate([[0], np.cumsum(sizes)]), lists.is_valid().to_numpy(zero_copy_only=False)


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``(words, offsets, valid)`` of a text column, as ``words`` cuts them: between runs of the
    same white space, never an empty word.  Cutting in the worker ships one text a row
    instead of one string a word."""
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    found, offsets, _ = flat_lists(lists)
    full = pc.not_equal(found, "")
    kept = full.to_numpy(zero_copy_only=False)
    if not kept.all():  # white space at a text's ends, and texts without a word
        found, offsets = found.filter(full), np.concatenate([[0], np.cumsum(kept)])[offsets]
    return found, offsets, valid


def row_parts(offsets: np.ndarray, most: int = _WORDS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` items, at least one row each."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = min(max(int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1, i + 1), n)
        yield i, j
        i = j


def text_parts(texts: pa.Array, most: int | None = None) -> Iterator[pa.Array]:
    """Slices of a text column of about ``most`` bytes, at least one row each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for i, j in row_parts(np.concatenate([[0], np.cumsum(sizes)]), SLICE_BYTES if most is None else most):
        yield texts.slice(i, j - i)


def sum_rows(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between offsets; zero for a row without items."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values, offsets[full], axis=0)
    return out


def to_lists(items: np.ndarray, offsets: np.ndarray, valid: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(items, kind), mask=pa.array(~valid) if len(valid) else None
    )


Fold = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _folded(
    texts: pa.Array, lookup: Callable[[pa.Array], np.ndarray], values: np.ndarray, fold: Fold, kind: pa.DataType
) -> pa.Array:
    """The lists of ``fold`` for a slice of texts; ``lookup`` finds the positions of distinct words."""
    found, offsets, valid = word_lists(texts)
    coded = found.dictionary_encode()
    at = lookup(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)] if len(found) else np.zeros(0, np.int64)
    done = [fold(values, at[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in row_parts(offsets)]
    items = np.concatenate([d[0] for d in done]) if done else np.zeros(0, np.int64)
    sizes = np.concatenate([np.diff(d[1]) for d in done]) if done else np.zeros(0, np.int64)
    return to_lists(items, np.concatenate([[0], np.cumsum(sizes)]), valid, kind)


def map_words(shipped, returns: str, fold: Fold, kind: pa.DataType) -> Callable[[Column], Column]:
    """An Arrow function from a text to a list of numbers.

    ``fold(values, positions, offsets)`` gets the word positions of many rows at once
    (-1: unknown) and returns the items of all their lists and the lists' offsets.  Only
    the distinct words of a slice are looked up.
    """

    @F.arrow_udf(returns)
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        position, values = shipped.value
        known = lambda found: np.array([position.get(w, -1) for w in found.to_pylist()], dtype=np.int64)
        for batch in parts:
            for texts in text_parts(batch):
                yield _folded(texts, known, values, fold, kind)

    return run


def _in_chunks(df: DataFrame, text_col: str, where_col: str | None, chunk_bytes: int) -> DataFrame:
    """The rows of ``df`` with the number of their ``__chunk``, and one row a chunk (all else null)
    with its distinct ``__words``; stored, as both are read again."""
    names = [*df.columns, "__chunk", "__words"]
    nullable = [T.StructField(f.name, f.dataType) for f in df.schema]
    schema = T.StructType([*nullable, T.StructField("__chunk", T.LongType()), T.StructField("__words", T.ArrayType(T.StringType()))])
    listed = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, seen, layout = TaskContext.get().partitionId() << _CHUNK_BITS, 0, [], None

        def closed() -> pa.RecordBatch:
            found = pc.unique(pa.concat_arrays(seen)).cast(pa.string())
            lists = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)
            empty = [pa.nulls(1, f.type) for f in layout]
            return pa.RecordBatch.from_arrays([*empty, pa.array([number], pa.int64()), lists], names)

        for batch in batches:
            layout, done = batch.schema, 0
            for texts in text_parts(_fed(batch, text_col, where_col)):
                rows = batch.slice(done, len(texts))
                done += len(texts)
                seen.append(pc.unique(word_lists(texts)[0]))
                marks = pa.array(np.full(len(texts), number, np.int64))
                yield pa.RecordBatch.from_arrays([*rows.columns, marks, pa.nulls(len(texts), listed)], names)
                size += (pc.sum(pc.binary_length(texts)).as_py() or 0) + 16 * len(texts)
                if size >= chunk_bytes:
                    yield closed()
                    number, size, seen = number + 1, 0, []
        if seen:
            yield closed()

    return durable(df.mapInArrow(run, schema), "chunks")


def _fed(rows: pa.RecordBatch | pa.Table, text_col: str, where_col: str | None) -> pa.Array:
    texts = rows.column(text_col)
    texts = texts if where_col is None else pc.if_else(rows.column(where_col), texts, pa.scalar(None, texts.type))
    return texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts


def join_words(
    df: DataFrame, text_col: str, table: DataFrame, value_cols: Sequence[str], name: str, returns: str, fold: Fold,
    kind: pa.DataType, keep: Sequence[str] | None = None, where_col: str | None = None, chunk_bytes: int | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``name``: what ``map_words`` gives, for a table of any size.

    ``table`` has one row per ``word`` and whole numbers in ``value_cols``.  Rows for which the
    boolean column ``where_col`` is not true count as rows without a text.
    """
    require_absent(df, "__chunk", "__words", name)
    kept = list(df.columns if keep is None else keep)
    stored = _in_chunks(df, text_col, where_col, CHUNK_BYTES if chunk_bytes is None else chunk_bytes)
    asked = stored.where("__words is not null").select(F.col("__chunk").alias("__of"), F.explode("__words").alias("word"))
    answers = asked.join(table.select("word", *value_cols), "word").select("__of", "word", *value_cols)
    rows = stored.where("__words is null").drop("__words")

    def chunk(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right["word"].combine_chunks().cast(pa.large_string())
        values = np.column_stack([right[c].to_numpy().astype(np.int64) for c in value_cols])
        lookup = lambda found: pc.fill_null(pc.index_in(found, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        lists = [_folded(texts, lookup, values, fold, kind) for texts in text_parts(_fed(left, text_col, where_col))]
        return left.select(kept).append_column(name, pa.chunked_array(lists, pa.list_(kind)))

    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in kept]).add(name, T.DataType.fromDDL(returns))
    return rows.groupBy("__chunk").cogroup(answers.groupBy("__of")).applyInArrow(chunk, schema)


def explode_words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id_col, pos, word)``, one row per word."""
    return df.select(id_col, F.posexplode(words(text_col)).alias("pos", "word"))
