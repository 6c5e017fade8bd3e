"""Repeated passages by sliding sentence spans.

A text is read as sentences; clauses count as sentences of their own.  Where ``REACH``
words stand without a mark, the one with the smallest hash begins a sentence as well, so
every ``REACH`` words hold a border, and where it lies depends on these words alone: a passage
is cut alike wherever it stands, but for fewer than ``REACH`` words at its ends.  At every
sentence begins a span: the shortest run of at least three sentences with at least 25 words.
A passage of 48 words therefore holds a span for certain, with or without marks.  Spans are
hashed and joined over the whole corpus; every place at which a span stands, but the first,
is removed.

Scripts that leave no space: in a run of more than ``LONG_RUN`` bytes without white space
every sign of three bytes or more is a word that counts half.

Two passes over the texts keep the shuffles small.  The first counts hashes alone and
turns the repeated ones into a bit field of fixed size; the second lets through the spans
whose bit is set, and only these travel with their places.  A bit field too full to hold
anything back costs time, not results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from textloom.llm.batches import field, flat, map_batches, row_slices
from textloom.llm.shingles import BLANK, run_hashes, word_hashes, word_spans
from textloom.plans import durable
from textloom.plans.skew import lookup_join

SENTENCES, WORDS = 3, 25   # of a span, at least
REACH = 8                  # so many words without a mark have a border by their hashes
LONG_RUN = 120             # bytes without white space, beyond which signs are words
FIELD_BITS = 26            # the bit field takes 8 MB

_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".!?,;:"]] = True
# Marks of other scripts that end a sentence or a clause.
_WIDE_MARKS = np.array([int.from_bytes(c.encode(), "big") for c in "。！？；：，、．｡।॥؟؛،…"], np.int64)


def _is_wide_mark(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether a word that ends before byte ``end`` ends in a mark of another script."""
    out = np.zeros(len(end), bool)
    some = np.flatnonzero(data[end - 1] >= 0x80)
    last = np.zeros(len(some), np.int64)
    for k in (3, 2, 1):
        last = last << 8 | np.where(end[some] >= k, data[np.maximum(end[some] - k, 0)], 0)
    out[some] = np.isin(last, _WIDE_MARKS) | np.isin(last & 0xFFFF, _WIDE_MARKS)
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, word offsets by row, weights)``: words between white space weigh 2; the signs
    of a long run are words that weigh 1."""
    start, end, at = word_spans(data, offsets)
    long = end - start > LONG_RUN
    if not long.any():
        return start, end, at, np.full(len(start), 2, np.int64)
    inside = np.zeros(len(data) + 1, np.int64)
    np.add.at(inside, start[long], 1)
    np.add.at(inside, end[long], -1)
    lead = (np.cumsum(inside)[:-1] > 0) & (data >= 0xE0)
    after = np.zeros(len(data) + 4, bool)  # what follows a sign is a word again
    for width, signs in ((3, lead & (data < 0xF0)), (4, lead & (data >= 0xF0))):
        after[np.flatnonzero(signs) + width] = True
    first = np.zeros(len(data) + 1, bool)
    first[start] = True
    blank = np.ones(len(data) + 1, bool)
    stop = np.zeros(len(data) + 1, bool)
    stop[end] = True
    blank[:-1] = BLANK[data]
    new = np.flatnonzero((first | np.append(lead, False) | after[:len(data) + 1]) & ~blank)
    stops = np.flatnonzero(stop | first | np.append(lead, False) | after[:len(data) + 1])
    ends = stops[np.searchsorted(stops, new, "right")]
    return new, ends, np.searchsorted(new, offsets), np.where(lead[new], 1, 2)


def sentence_starts(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray, hashes: np.ndarray
) -> np.ndarray:
    """Which words begin a sentence, for rows whose words are ``at[i]:at[i + 1]``."""
    n = len(start)
    new = np.zeros(n + 1, bool)
    new[at] = True
    new = new[:n]
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    new[1:] |= _MARK[data[end[:-1] - 1]] | _is_wide_mark(data, end[:-1]) | (lines[start[1:]] > lines[end[:-1]])
    if n >= REACH:
        # windows of REACH words without a border choose the word with the smallest hash, the last of equals
        window = n - REACH + 1
        marked = np.concatenate([[0], np.cumsum(new)])
        open_ = marked[REACH:] == marked[:window]
        least, where = hashes[:window].copy(), np.arange(window)
        for k in range(1, REACH):
            lower = hashes[k:k + window] <= least
            least[lower] = hashes[k:k + window][lower]
            where[lower] = np.arange(k, k + window)[lower]
        new[where[open_]] = True
    return np.flatnonzero(new)


def spans(column: pa.Array):
    """``(row, hashes, starts, ends)`` per slice: the spans of a batch of texts; starts and ends
    are bytes within the text."""
    data, offsets = flat(column)
    for i, j in row_slices(offsets):
        at = offsets[i:j + 1] - offsets[i]
        part = data[offsets[i]:offsets[j]]
        start, end, words_at, weights = _words(part, at)
        if not len(start):
            continue
        words = word_hashes(part, start, end)
        marks = sentence_starts(part, start, end, words_at, words)
        bounds = np.append(marks, len(start))
        row = np.searchsorted(words_at, marks, "right") - 1
        heavy = np.concatenate([[0], np.cumsum(weights)])
        last = np.maximum(np.searchsorted(heavy[bounds], heavy[marks] + 2 * WORDS), np.arange(len(marks)) + SENTENCES)
        last = np.minimum(last, len(marks))
        stop = bounds[last]
        enough = heavy[stop] - heavy[marks] >= 2 * WORDS
        ok = (stop <= words_at[row + 1]) & enough & (last - np.arange(len(marks)) >= SENTENCES)
        if not ok.any():
            continue
        row, lo, hi = row[ok], marks[ok], stop[ok]
        hashes = run_hashes(words, lo, hi)
        yield i + row, hashes.view(np.int64), start[lo] - at[row], end[hi - 1] - at[row]


def _repeated_field(docs: DataFrame, text_col: str) -> bytes:
    """One bit for every hash that stands in more than one place, by its lowest bits."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [h for _, h, _, _ in spans(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["hash"]) if found else None

    hashes = map_batches(docs.select(F.col(f"`{text_col}`").alias("text")), run, [T.StructField("hash", T.LongType())])
    twice = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slot = F.pmod("hash", F.lit(1 << FIELD_BITS)) + 1
    parts = twice.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )
    out = bytearray(1 << FIELD_BITS - 3)
    for r in parts.collect():  # at most 2**FIELD_BITS bits
        lo = (r["k"] - 1) * len(r["bits"])
        out[lo:lo + len(r["bits"])] = r["bits"]
    return bytes(out)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text_hash, start, end, first_id)``: what is to be removed from each text.

    One row per maximal stretch of sentences that are covered by spans whose first place
    is elsewhere; ``start`` and ``end`` are bytes of the text, ``first_id`` is the document
    that holds the first span's first place.  First means the smallest id (null before all
    others), then text hash, then place.  Rows equal in id and text are one document.
    Null and short texts have no spans; a passage that repeats within one text counts.
    Other columns are ignored, whatever their names; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(_repeated_field(docs, text_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        marked = np.frombuffer(bits.value, np.uint8)
        rows, hashes, starts, ends = [], [], [], []
        for row, found, lo, hi in spans(batch.column(2)):
            slot = found & ((1 << FIELD_BITS) - 1)
            some = (marked[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            rows.append(row[some])
            hashes.append(found[some])
            starts.append(lo[some])
            ends.append(hi[some])
        if not rows:
            return None
        take = pa.array(np.concatenate(rows))
        return pa.RecordBatch.from_arrays(
            [pc.take(batch.column(0), take), pc.take(batch.column(1), take),
             *(pa.array(np.concatenate(x).astype(np.int64)) for x in (hashes, starts, ends))],
            ["id", "text_hash", "hash", "start", "end"],
        )

    text = F.col(f"`{text_col}`")
    long = T.LongType()
    places = durable(
        map_batches(
            docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")), run,
            [field(docs, id_col, "id"), *(T.StructField(c, long) for c in ("text_hash", "hash", "start", "end"))],
        ), "span-places",
    )
    firsts = durable(
        places.groupBy("hash").agg(
            F.min(F.struct("id", "text_hash", "start")).alias("first"), F.count(F.lit(1)).alias("w")
        ).where("w > 1"), "span-firsts",
    )
    later = lookup_join(places, firsts, ["hash"], "w").where(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash"))
          & (F.col("start") == F.col("first.start")))
    )
    rows = later.select("id", "text_hash", "start", "end", F.col("first.id").alias("first_id")).dropDuplicates(
        ["id", "text_hash", "start", "end"]
    )
    by_text = Window.partitionBy("id", "text_hash").orderBy("start", "end")
    reach = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")).withColumn(
        "part", F.sum("new").over(by_text)
    )
    return parts.groupBy("id", "text_hash", "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("first_id", "start").alias("first_id")
    ).select(F.col("id").alias(id_col), "text_hash", "start", "end", "first_id")


def without_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the stretches of ``found`` cut out of their texts; every row stays."""
    keyed = found.groupBy(F.col(f"`{id_col}`").alias("id"), "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")
    )
    text, cuts = docs[f"`{text_col}`"], keyed["cuts"]
    raw, none = F.encode(text, "UTF-8"), F.lit(0).cast("long")
    stops = F.concat(F.transform(cuts, lambda c: c["start"]), F.array(F.octet_length(text).cast("long")))
    begins = F.concat(F.array(none), F.transform(cuts, lambda c: c["end"]))
    kept = F.concat_ws("", F.zip_with(begins, stops, lambda b, e: F.decode(
        F.substring(raw, (b + 1).cast("int"), (e - b).cast("int")), "UTF-8"
    )))
    same = docs[f"`{id_col}`"].eqNullSafe(keyed["id"]) & (F.xxhash64(text) == keyed["text_hash"])
    return docs.join(keyed, same, "left").select(*[
        F.when(cuts.isNull(), text).otherwise(kept).alias(c) if c == text_col else docs[f"`{c}`"] for c in docs.columns
    ])
