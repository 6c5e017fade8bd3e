"""Token counts: lengths only, by batch encoding in an Arrow function.

A batch of rows is cut into slices of equal bytes, and a long text into several pieces.
Pieces are cut where a line feed or a space stands, which is safe for a vocabulary whose
pre-tokeniser drops white space: no token reaches over it.  The distinct words of a
slice are encoded in batches of equal bytes; their lengths are added up by text.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from textloom.llm.batches import SLICE_BYTES, field, flat, map_batches, narrow, row_slices

ENCODE_BYTES = 256 << 10   # text handed to the library in one call
KEPT_WORDS = 400_000       # words whose lengths a worker remembers; then it starts anew
KEPT_LENGTH = 64           # longer words are not remembered


class Counter:
    """Encodes words with the library and remembers the lengths of those it has seen."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def encode(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        batch, size = [], 0
        for t in texts:
            batch.append(t)
            size += len(t) + 8
            if size >= ENCODE_BYTES:
                out += map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))
                batch, size = [], 0
        out += map(len, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False))
        return out

    def lengths(self, words: list[str]) -> np.ndarray:
        known = self.known
        got = [known.get(w, -1) for w in words]
        new = [i for i, n in enumerate(got) if n < 0]
        if new:
            fresh = [words[i] for i in new]
            if len(known) > KEPT_WORDS:
                known.clear()
            for i, w, n in zip(new, fresh, self.encode(fresh)):
                got[i] = n
                if len(w) <= KEPT_LENGTH:
                    known[w] = n
        return np.array(got, np.int64)

    def count_words(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text, by its words."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        each = self.lengths(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        ends = np.concatenate([[0], np.cumsum(each)])
        at = lists.offsets.to_numpy().astype(np.int64)
        return ends[at[1:] - at[0]] - ends[at[:-1] - at[0]]


def _pieces(text: bytes, target: int) -> list[str]:
    """A long text in pieces of about ``target`` bytes, cut after a space or line feed."""
    out, lo = [], 0
    while len(text) - lo > target:
        cut = max(text.rfind(b" ", lo, lo + target), text.rfind(b"\n", lo, lo + target))
        if cut < lo:  # one word longer than a piece stays whole
            found = [p for p in (text.find(b" ", lo + target), text.find(b"\n", lo + target)) if p >= 0]
            if not found:
                break
            cut = min(found)
        out.append(text[lo:cut + 1].decode())
        lo = cut + 1
    return [*out, text[lo:].decode()]


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048,
    space_is_boundary: bool = True, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` for every row of ``docs``.

    ``vocabulary`` is the content of a tokenizer's JSON file (not a path: workers need no
    file).  With ``space_is_boundary=False`` whole texts are encoded.  No special tokens
    are added; their strings inside a text are handled as the library does by default.
    A null text counts as empty; repeated rows and null ids each give a row of their own;
    other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(vocabulary)
    made: list[Counter] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Counter(shipped.value))
        counter = made[0]
        texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
        _, at = flat(texts)
        n = np.zeros(len(texts), np.int64)
        for i, j in row_slices(at, slice_bytes):
            part = texts.slice(i, j - i)
            if not space_is_boundary:
                n[i:j] = counter.encode(part.to_pylist())
            elif j - i == 1 and at[j] - at[i] > slice_bytes:
                n[i] = sum(
                    int(counter.count_words(pa.array([p], pa.large_string()))[0])
                    for p in _pieces(part[0].as_py().encode(), slice_bytes)
                )
            else:
                n[i:j] = counter.count_words(part)
        sizes = pa.array(np.diff(at))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), sizes, pa.array(n), pa.array(n > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"]
        )

    return map_batches(
        narrow(docs, id=id_col, text=text_col), run,
        [
            field(docs, id_col), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ],
    )
