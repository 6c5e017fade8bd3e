"""Arrow columns of text as one run of bytes, cut into pieces of bounded size.

The operators of this package read texts as UTF-8 bytes in numpy.  A batch is worked
through in slices of a megabyte, whatever its number of rows, and a single long
text is cut into several slices, so memory does not follow the longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

SLICE_BYTES = 1 << 20


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; row i is ``bytes[offsets[i]:offsets[i+1]]``.
    A null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    n, first = len(column), column.offset
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64, n + 1, first * 8)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, target: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole rows of about ``target`` bytes; a longer row is a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + target, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def byte_slices(offsets: np.ndarray, target: int = SLICE_BYTES) -> Iterator[tuple[int, int, int, int]]:
    """``(lo, hi, i, j)``: bytes ``lo:hi`` of rows ``i:j``; a long row comes in several parts."""
    for i, j in row_slices(offsets, target):
        lo, end = int(offsets[i]), int(offsets[j])
        if j - i > 1 or end - lo <= target:
            yield lo, end, i, j
        else:
            for at in range(lo, end, target):
                yield at, min(at + target, end), i, j


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[starts[k]:ends[k]]`` for adjoining ranges, 0 for an empty one."""
    out = np.zeros((len(starts), *values.shape[1:]), values.dtype)
    full = np.flatnonzero(ends > starts)
    if len(full):
        out[full] = np.add.reduceat(values, starts[full], axis=0)
    return out


def minima(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, none) -> np.ndarray:
    """Minimum of ``values[starts[k]:ends[k]]`` for adjoining ranges, ``none`` for an empty one."""
    out = np.full(len(starts), none, values.dtype)
    full = np.flatnonzero(ends > starts)
    if len(full):
        out[full] = np.minimum.reduceat(values, starts[full])
    return out


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, starts, ends)``: runs of rows, sorted by their first ``keys`` columns (whole
    numbers), in which every group is complete."""
    rest: list[pa.RecordBatch] = []

    def joined() -> tuple[pa.RecordBatch, np.ndarray]:
        rows = pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
        new = np.zeros(rows.num_rows - 1, bool)
        for k in range(keys):
            column = rows.column(k).to_numpy()
            new |= column[1:] != column[:-1]
        return rows, np.concatenate([[0], np.flatnonzero(new) + 1, [rows.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        last = [batch.column(k)[-1] for k in range(keys)]
        if all(rest[0].column(k)[0] == last[k] for k in range(keys)):
            continue  # still one group
        rows, edges = joined()
        rest = [rows.slice(edges[-2])]  # the last group may go on in the next batch
        yield rows.slice(0, edges[-2]), edges[:-2], edges[1:-1]
    if rest:
        rows, edges = joined()
        yield rows, edges[:-1], edges[1:]


def field(df: DataFrame, name: str, new: str | None = None) -> T.StructField:
    """The type of a column, for the schema of a function's result."""
    return T.StructField(new or name, df.schema[name].dataType, True)


def map_batches(
    df: DataFrame, run: Callable[[pa.RecordBatch], pa.RecordBatch | None], fields: Sequence[T.StructField]
) -> DataFrame:
    """``run`` over every Arrow batch; a batch that gives None adds no rows."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = run(batch) if batch.num_rows else None
            if out is not None:
                yield out
        pa.default_memory_pool().release_unused()  # workers live on after their task

    return df.mapInArrow(over, T.StructType(list(fields)))


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of ours: other columns cannot clash."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()])
