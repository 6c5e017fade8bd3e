"""Token counts, token ids, fixed-length rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.functions.arrays import attention_mask, pad_right
from textloom.functions.text import WS_CHARS, word_count
from textloom.plans.checks import require_absent, require_columns, require_unique
from textloom.plans.barrier import computed
from textloom.plans.lineage import durable
from textloom.plans.lexicon import explode_words, fits_broadcast, join_words, map_words, ship
from textloom.plans.ordering import with_row_index, with_running_total

# runs of letters, runs of digits, single signs
PRE_TOKEN = r"\p{L}+|\p{N}+|[^" + WS_CHARS + r"\p{L}\p{N}]"


def _python_counter(load: Callable[[], Callable[[list[str]], list[int]]]) -> Callable[[Column], Column]:
    """A counter that loads its tokenizer once per worker and works on Arrow batches."""

    @F.pandas_udf("int")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = load()
        for s in parts:
            known = s.dropna()
            yield pd.Series(lengths(known.tolist()), index=known.index, dtype="Int32").reindex(s.index)

    return count


def token_counter(tokenizer: str | Callable = "words") -> Callable[[Column], Column]:
    """Column function for a tokenizer.

    ``words`` and ``regex`` are built-in expressions; a callable is a loader that
    returns a function from a list of texts to their token counts.
    """
    if callable(tokenizer):
        return _python_counter(tokenizer)
    if tokenizer == "words":
        return word_count
    if tokenizer == "regex":
        return lambda c: F.regexp_count(c, F.lit(PRE_TOKEN))
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


def count_tokens(
    df: DataFrame, tokenizer: str | Callable = "words", text_col: str = "text", name: str = "n_tokens"
) -> DataFrame:
    """``df`` with the number of tokens per row, special tokens not counted."""
    require_columns(df, text_col)
    return computed(df, {name: token_counter(tokenizer)(F.col(text_col))})


def build_vocabulary(df: DataFrame, text_col: str = "text", first_id: int = 0) -> DataFrame:
    """``(word, id)``: ids in order of falling frequency, then of the word itself."""
    require_columns(df, text_col)
    seen = explode_words(df.withColumn("__row", F.lit(0)), "__row", text_col)
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    ranked = with_row_index(counts, F.col("n").desc(), F.col("word"))
    return ranked.select("word", (F.col("row_idx") + first_id).cast("int").alias("id"))


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    bos_id: int | None = None,
    unk_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    in_place: bool | None = None,
) -> DataFrame:
    """``(id_col, input_ids, attention_mask)`` of whole documents, nothing truncated.

    Words outside the vocabulary become ``unk_id``, or are left out if it is None.
    """
    require_columns(df, id_col, text_col)
    ids = with_ids(df, vocabulary, "__ids", bos_id, unk_id, text_col, in_place, [id_col]).select(id_col, F.col("__ids").alias("input_ids"))
    return ids.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))


def with_ids(
    df: DataFrame,
    vocabulary: DataFrame,
    name: str = "input_ids",
    bos_id: int | None = None,
    unk_id: int | None = None,
    text_col: str = "text",
    in_place: bool | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``df`` (or its columns ``keep``) with the token ids of its whole texts; null for a null text.
    Ids depend on the text alone; a vocabulary too large to be shipped is joined by word (``in_place``)."""
    require_columns(df, text_col)
    require_absent(df, name)
    head = [] if bos_id is None else [bos_id]
    if in_place is None:
        in_place = fits_broadcast(vocabulary, "word")

    def ids_of(values: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stand_in = np.array([-1 if unk_id is None else unk_id], np.int64)  # an unknown word is at -1
        ids = np.concatenate([values[:, 0], stand_in])[at]
        used = np.ones(len(at), bool) if unk_id is not None else at >= 0
        ends = np.concatenate([[0], np.cumsum(used)])[offsets]
        ids = np.insert(ids[used], np.repeat(ends[:-1], len(head)), np.tile(head, len(offsets) - 1).astype(np.int64))
        return ids, ends + np.arange(len(offsets)) * len(head)

    if in_place:
        column = map_words(ship(vocabulary, "word", ["id"]), "array<int>", ids_of, pa.int32())(F.col(text_col))
        return computed(df, {name: column}, keep)
    needed = df if keep is None else df.select(*dict.fromkeys([*keep, text_col]))
    return join_words(needed, text_col, vocabulary, ["id"], name, "array<int>", ids_of, pa.int32(), keep)


def truncate_pad(df: DataFrame, pad_id: int, max_len: int = 256, ids_col: str = "input_ids") -> DataFrame:
    """Rows of exactly ``max_len`` ids with their mask; longer ones are cut, as the
    models that read them demand."""
    require_columns(df, ids_col)
    return df.withColumns({
        "attention_mask": attention_mask(ids_col, max_len),
        ids_col: pad_right(ids_col, pad_id, max_len),
    })


# --- packing ------------------------------------------------------------------------

MODES = ("batch", "global")
STRETCH_TOKENS = 4 << 20   # tokens that one window of a global packing puts in order
MAX_STRETCHES = 100_000    # stretches ever; a larger corpus has longer ones


def _offsets(lengths: DataFrame, map_batch: int, id_col: str, mode: str) -> DataFrame:
    """``(id_col, row_idx, batch, start, n, batch_total)`` of ``(id_col, n)``."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "global":
        # the running total needs no batch: slices of the range partition and their bases
        total = lengths.agg(F.sum("n")).first()[0] or 0
        rows = with_running_total(lengths, "n", id_col, name="start")
        whole = F.lit(0).cast("long").alias("batch")
        return rows.select(id_col, "row_idx", whole, "start", "n", F.lit(total).cast("long").alias("batch_total"))
    if map_batch < 1:
        raise ValueError("map_batch must be positive")
    rows = with_row_index(lengths, id_col).withColumn("batch", F.floor(F.col("row_idx") / map_batch))
    whole = Window.partitionBy("batch")
    before = whole.orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        id_col, "row_idx", "batch",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
        "n",
        F.sum("n").over(whole).alias("batch_total"),
    )


def _length(ids_col: str) -> Column:
    return F.coalesce(F.size(ids_col), F.lit(0)).cast("long").alias("n")


def token_offsets(
    df: DataFrame, map_batch: int = 1000, id_col: str = "doc_id", ids_col: str = "input_ids", mode: str = "batch"
) -> DataFrame:
    """``(id_col, row_idx, batch, start, n, batch_total)``: where each row's tokens begin
    in its batch.

    ``mode="batch"``: a batch is ``map_batch`` consecutive rows by ``id_col``, so windows over
    it stay small.  ``mode="global"``: the whole table is batch 0, and ``start`` is a running
    total in two levels.  Token arrays take no part, only their lengths, which are stored
    first so that nothing is tokenised twice."""
    require_columns(df, id_col, ids_col)
    lengths = durable(df.select(id_col, _length(ids_col)), "lengths")
    require_unique(lengths.select(id_col), id_col)
    return _offsets(lengths, map_batch, id_col, mode)


def pack(
    df: DataFrame, block_size: int, map_batch: int = 1000, id_col: str = "doc_id", ids_col: str = "input_ids",
    mode: str = "batch",
) -> DataFrame:
    """``(batch, block, input_ids, attention_mask, labels)``: the token arrays of each
    batch put end to end and cut into blocks; the rest of a batch is dropped.

    With ``mode="global"`` the whole table is batch 0: blocks run across all rows, and only one
    remainder of fewer than ``block_size`` tokens is dropped in all.  Rows stand in the order
    of ``id_col``; a null array counts as empty; an empty table gives no block.

    Ids must be unique.  Token arrays are stored once and meet their offsets by id; pieces that land in
    a whole block are cut out and shuffled to it, and a block collects at most ``block_size`` of them.
    In a global packing they are shuffled once only (``_stretches``).
    """
    require_columns(df, id_col, ids_col)
    if block_size < 1:
        raise ValueError("block_size must be positive")
    stored = durable(df.select(id_col, ids_col, _length(ids_col)), "tokens")
    require_unique(stored.select(id_col), id_col)
    if mode == "global":
        return _as_blocks(_global_pieces(stored, block_size, id_col, ids_col), block_size, "stretch").withColumn(
            "batch", F.lit(0).cast("long")
        ).select("batch", "block", "input_ids", "attention_mask", "labels")
    at = _offsets(stored.select(id_col, "n"), map_batch, id_col, mode).drop("row_idx")
    rows = stored.drop("n").join(at.where("n > 0"), id_col)
    size = F.lit(block_size).cast("long")
    return _as_blocks(_pieces(rows, block_size, F.floor(F.col("batch_total") / size), ids_col, "batch"), block_size, "batch")


def _pieces(rows: DataFrame, block_size: int, blocks: Column, ids_col: str, *keep: str) -> DataFrame:
    """``(*keep, start, block, part)``: the parts of rows at ``start`` that lie in the first ``blocks``
    blocks.  They are cut before the explode, so no output row carries a whole document."""
    size = F.lit(block_size).cast("long")
    first = F.floor(F.col("start") / size)
    last = F.least(F.floor((F.col("start") + F.col("n") - 1) / size), blocks - 1)

    def piece(block: Column) -> Column:
        lo = F.greatest(block * size - F.col("start"), F.lit(0))
        hi = F.least((block + 1) * size - F.col("start"), F.col("n"))
        return F.struct(
            block.alias("block"), F.slice(ids_col, (lo + 1).cast("int"), (hi - lo).cast("int")).alias("part")
        )

    return rows.where(last >= first).select(*keep, "start", F.inline(F.transform(F.sequence(first, last), piece)))


def _as_blocks(pieces: DataFrame, block_size: int, group: str) -> DataFrame:
    blocks = pieces.groupBy(group, "block").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "part"))), lambda p: p["part"])).alias("input_ids")
    )
    return blocks.select(
        group, "block", "input_ids",
        F.array_repeat(F.lit(1), block_size).alias("attention_mask"),
        F.col("input_ids").alias("labels"),
    )


def _stretches(stored: DataFrame, block_size: int, id_col: str) -> tuple[int, int, pa.Table]:
    """``(total, length, firsts)``: the tokens of all rows, the length of a stretch of them (whole
    blocks), and the rows ``(id, start, n)`` in which a stretch begins, one a stretch at most.

    Any other row lies whole in the stretch that the nearest of these rows before it ends in,
    so a row's stretch follows from its id, without a join."""
    lengths = stored.select(F.col(id_col).alias("id"), "n").where("n > 0")
    total = lengths.agg(F.sum("n")).first()[0] or 0
    length = -(-max(STRETCH_TOKENS, -(-total // MAX_STRETCHES)) // block_size) * block_size
    rows = with_running_total(lengths, "n", "id", name="start")
    begins = F.floor((F.col("start") + F.col("n") - 1) / length) > F.floor((F.col("start") - 1) / length)
    firsts = rows.where(begins).select("id", "start", "n").toArrow()
    return total, length, firsts.sort_by("start")


def _global_pieces(stored: DataFrame, block_size: int, id_col: str, ids_col: str) -> DataFrame:
    """``(stretch, start, block, part)`` of one packing of all rows.

    The tokens of the corpus are dealt in stretches of equal length, whatever the rows'
    lengths, and shuffled to them once; a window over a stretch gives the places, and as a
    block lies in one stretch, its parts are there already."""
    total, length, firsts = _stretches(stored, block_size, id_col)
    shipped = stored.sparkSession.sparkContext.broadcast(firsts)

    @F.arrow_udf("array<struct<stretch:bigint,lo:int,n:bigint>>")
    def parts_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known, starts, sizes = (shipped.value[c].to_numpy() for c in ("id", "start", "n"))
        for ids, n in batches:
            ids, n = ids.to_numpy(zero_copy_only=False), n.to_numpy()
            at = np.searchsorted(known, ids, "right") - 1
            first = known[at] == ids
            end = (starts[at] + sizes[at] - 1) // length
            begin = np.where(first, starts[at] // length, end)
            count = end - begin + 1
            row = np.repeat(np.arange(len(ids)), count)
            offsets = np.concatenate([[0], np.cumsum(count)])
            stretch = begin[row] + np.arange(len(row)) - offsets[row]
            lo = np.where(first[row], np.maximum(stretch * length - starts[at][row], 0), 0)
            hi = np.where(first[row], np.minimum((stretch + 1) * length - starts[at][row], n[row]), n[row])
            parts = pa.StructArray.from_arrays([pa.array(stretch), pa.array(lo.astype(np.int32)), pa.array(hi - lo)], ["stretch", "lo", "n"])
            yield pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), parts)

    rows = computed(stored.where("n > 0"), {"parts": parts_of(F.col(id_col), F.col("n"))}, [id_col, ids_col])
    cut = F.transform("parts", lambda p: F.struct(p["stretch"], p["lo"], p["n"], F.slice(ids_col, p["lo"] + 1, p["n"].cast("int")).alias(ids_col)))
    dealt = rows.select(F.col(id_col).alias("id"), F.inline(cut))
    before = Window.partitionBy("stretch").orderBy("id", "lo").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("stretch") * length + F.coalesce(F.sum("n").over(before), F.lit(0))
    return _pieces(dealt.withColumn("start", start), block_size, F.lit(total // block_size), ids_col, "stretch")


def pack_dropped(
    df: DataFrame, block_size: int, map_batch: int = 1000, id_col: str = "doc_id", ids_col: str = "input_ids",
    mode: str = "batch",
) -> DataFrame:
    """Per batch: tokens that came in, whole blocks, tokens lost as the remainder."""
    at = token_offsets(df, map_batch, id_col, ids_col, mode)
    return at.groupBy("batch").agg(F.sum("n").alias("tokens")).select(
        "batch", "tokens",
        F.floor(F.col("tokens") / block_size).alias("blocks"),
        (F.col("tokens") % block_size).alias("dropped"),
    )
