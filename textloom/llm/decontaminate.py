"""Benchmark decontamination: items found in documents by edit distance.

A document's windows begin at every word, and at every sign of three bytes or more, as
scripts of such signs often leave no space; they are as long as the items.  The random
walk of Chakraborty, Goldenberg and Koucky (CGK, 2016) embeds a window: at every step it
writes the byte it stands on and moves on or stays, by a random bit that depends on the
step and the byte, so strings at a small edit distance get embeddings at a small Hamming
distance.  Keys are bytes of the embedding at sampled steps (bit sampling), repeated over
several walks and samples; a window that shares a key with an item's window is aligned
with the item and the exact edit distance decides.

One walk serves items of all sizes: the sampled steps of a short item are the first of
those of a long one, so its key is the long one's before the last steps are added.

Items of fewer bytes than a walk needs are looked for as they are, between word borders.

Items are shipped in blocks of bounded size, each with one pass over the documents; no
document is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from textloom.llm.batches import field, flat, map_batches, row_slices

MAX_RATIO = 0.2           # edits per byte of the item
BLOCK_BYTES = 1 << 19     # item text that is shipped at once
# Random walks, and keys per walk: so many that of copies with MAX_RATIO edits nine in ten are found
# in every class of sizes.
WALKS, SAMPLES = 4, 8
# (shortest item in bytes, steps of the walk, sampled steps, share of the steps at which the embeddings
# of a hit agree at least): an item belongs to the first that fits
CLASSES = ((100, 48, 15, 0.8), (80, 42, 13, 0.8), (40, 28, 11, 0.7), (24, 20, 9, 0.7))
PART, SLICE = 2 << 20, 1 << 19  # bytes that are brought to normal form, and searched, at a time
GROUP = 1 << 15           # windows that are walked together
EARLY = (20, 28)          # steps after which windows that can share no key any more are left behind
DIAGONAL = 16             # hits whose alignments differ by less are checked once

_BLANK = np.zeros(256, bool)
_BLANK[[0, 9, 10, 11, 12, 13, 32]] = True
_FIXED = np.random.default_rng(2016)
STEPS = CLASSES[0][1]
_MOVES = _FIXED.integers(0, 2, (WALKS, STEPS, 256), dtype=np.int64)
_MOVES[:, :, 0] = 0       # a walk stays on the end of its text
# A byte's moves at all steps of a walk as bits, and the byte itself above them.
_BITS = (_MOVES << np.arange(STEPS)[None, :, None]).sum(axis=1) | np.arange(256) << 48
_TIMES = _FIXED.integers(-(1 << 62), 1 << 62, STEPS) * 2 + 1
_ODD = np.int64(0x5851F42D4C957F2D)


def _chosen() -> np.ndarray:
    """Which steps each key samples, by walk and sample: of every class's steps as many as it asks
    for, those of the shorter classes among them."""
    taken = np.zeros((WALKS, SAMPLES, STEPS), bool)
    for walk in range(WALKS):
        for sample in range(SAMPLES):
            low = many = 0
            for _, steps, some, _ in reversed(CLASSES):
                taken[walk, sample, low + _FIXED.choice(steps - low, some - many, replace=False)] = True
                low, many = steps, some
    return taken


_CHOSEN = _chosen()

_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = True
_ALNUM[0x80:] = True


@dataclass(frozen=True)
class Index:
    """A block of items: texts, and the keys of their windows."""

    ids: list
    texts: list[bytes]
    data: np.ndarray          # the texts end to end, each ended by a zero byte
    at: np.ndarray            # where each begins
    keys: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]  # (class, walk, sample): see _table
    early: dict[tuple[int, int], np.ndarray]  # (walk, steps): refuses most beginnings of other keys, a bit a sample
    masks: dict[int, dict[int, int]]  # by item, as they are asked for: see byte_masks
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by size: sorted hashes of short items, and the items

    @property
    def classes(self) -> list[int]:
        return sorted({k for k, _, _ in self.keys})


def normal(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case texts with a closing blank: runs of white space as one space, each text
    ended by a zero byte.  Returns bytes and offsets."""
    data, at = flat(column)
    if not len(data):
        return np.zeros(0, np.uint8), at
    blank = _BLANK[data]
    first = np.zeros(len(data), bool)
    first[at[:-1][at[1:] > at[:-1]]] = True
    keep = ~blank | ~np.concatenate([[True], blank[:-1]])
    keep &= ~(first & blank)
    ends = at[1:][at[1:] > at[:-1]] - 1
    keep[ends] = True
    out = np.where(blank, np.uint8(32), data)
    out[ends] = 0
    gone = np.flatnonzero(~keep)
    if len(gone):
        out, at = out[keep], at - np.searchsorted(gone, at)
    closing = at[1:][at[1:] > at[:-1]] - 1
    spare = closing[(closing > 0)]
    spare = spare[out[spare - 1] == 32] - 1  # a blank before the end becomes the end
    out[spare] = 0
    return out, at


def window_starts(data: np.ndarray, before: int = 0) -> np.ndarray:
    """Where words begin, and signs of three bytes or more; ``before`` is the byte before the first.
    The texts of ``data`` end in zero bytes."""
    gap = (data == 32) | (data == 0)
    after = np.concatenate([[before in (0, 32)], gap[:-1]])
    return np.flatnonzero(~gap & (after | (data >= 0xE0)))


def _keys(data: np.ndarray, starts: np.ndarray, kinds: list[int], walk: int, early: dict[tuple[int, int], np.ndarray] | None = None):
    """``(class, starts, keys)`` of the windows at ``starts`` under a walk, the keys by sample.

    One lookup a step gives the byte that a window stands on and whether it goes on.  Windows
    are walked in groups that fit the processor's caches.  With the tables ``early`` those of
    which no key begins like one of the items' go no further.  Keys hold until the next are asked for."""
    return _walked(data, starts, {CLASSES[kind][1]: kind for kind in kinds}, walk, early)


def _walked(data: np.ndarray, starts: np.ndarray, ends: dict[int, int], walk: int, early: dict | None = None):
    """See ``_keys``; ``ends`` has the steps after which keys are wanted."""
    bits = _BITS[walk][data]
    chosen = [[s for s in range(SAMPLES) if _CHOSEN[walk, s, j]] for j in range(STEPS)]
    for lo in range(0, len(starts), GROUP):
        first = starts[lo:lo + GROUP]
        at = first.astype(np.int64)
        word, move, keys = np.empty_like(at), np.empty_like(at), np.zeros((SAMPLES, len(at)), np.int64)
        for j in range(max(ends)):
            np.take(bits, at, out=word, mode="clip")
            np.right_shift(word, j, out=move)
            move &= 1
            at += move
            if chosen[j]:
                word *= _TIMES[j]
                for sample in chosen[j]:
                    keys[sample] += word
            if j + 1 in ends:
                yield ends[j + 1], first, keys
            if early is not None and j + 1 in EARLY and j + 1 < max(ends):
                mark, some = early[walk, j + 1], np.zeros(len(at), np.uint8)
                for sample in range(SAMPLES):
                    some |= mark[_slots(keys[sample], len(mark))] & np.uint8(1 << sample)
                on = np.flatnonzero(some)
                if not len(on):
                    break
                first, at, keys = first[on], at[on], keys[:, on]
                word, move = np.empty_like(at), np.empty_like(at)


def _agreement(a: np.ndarray, at: np.ndarray, b: np.ndarray, to: np.ndarray, kind: int, walk: int) -> np.ndarray:
    """Share of the steps at which the embeddings of windows of ``a`` and of ``b`` agree."""
    x, y, same = at.astype(np.int64), to.astype(np.int64), np.zeros(len(at), np.int64)
    bits = _BITS[walk]
    for j in range(CLASSES[kind][1]):
        p, q = np.take(bits, np.take(a, x, mode="clip")), np.take(bits, np.take(b, y, mode="clip"))
        same += p == q
        x += p >> j & 1
        y += q >> j & 1
    return same / CLASSES[kind][1]


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    """Places in a table of ``size`` entries, a power of two: the highest bits, to which all others of
    a byte went when it was multiplied."""
    return (keys.view(np.uint64) >> np.uint64(65 - size.bit_length())).view(np.int64)


def _room(n: int) -> int:
    """Entries of a table that refuses most keys but ``n``."""
    return 1 << min(20, max(14, (16 * n).bit_length()))


def _table(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, the places of their windows, and a table that refuses most other keys at once."""
    order = np.argsort(keys, kind="stable")
    mark = np.zeros(_room(len(keys)), bool)
    mark[_slots(keys, len(mark))] = True
    return keys[order], places[order], mark


def _beginnings(data: np.ndarray, places: np.ndarray, steps: int, walk: int) -> np.ndarray:
    """A table in which bit ``s`` is set where a window's key of sample ``s`` stands after some steps."""
    mark = np.zeros(min(4 * _room(len(places)), 1 << 20), np.uint8)
    for _, _, keys in _walked(data, places, {steps: 0}, walk):
        for sample in range(SAMPLES):
            mark[_slots(keys[sample], len(mark))] |= np.uint8(1 << sample)
    return mark


def _class_of(size: int) -> int | None:
    return next((k for k, (least, *_) in enumerate(CLASSES) if size >= least), None)


def build_index(ids: list, column: pa.Array) -> Index:
    data, at = normal(column)
    texts = [data[at[i]:at[i + 1]].tobytes().rstrip(b"\0") for i in range(len(ids))]
    by_class: dict[int, list[np.ndarray]] = {}
    by_size: dict[int, list[tuple[int, int]]] = {}
    starts = window_starts(data) if len(data) else np.zeros(0, np.int64)
    for i, text in enumerate(texts):
        kind = _class_of(len(text))
        if kind is not None:
            # a walk reads about half as many bytes as it has steps; windows nearer the end are left out
            reach = int(CLASSES[kind][1] * 0.8)
            lo, hi = np.searchsorted(starts, [at[i], at[i] + max(len(text) - reach, 0) + 1])
            by_class.setdefault(kind, []).append(starts[lo:hi])
        elif text:
            by_size.setdefault(len(text), []).append((i, int(_prefix_hash(text))))
    keys, early = {}, {}
    for walk in range(WALKS):
        for kind, found in by_class.items():
            places = np.concatenate(found)
            found_keys = [k for _, _, k in _keys(data, places, [kind], walk)]
            own = np.concatenate([np.zeros((SAMPLES, 0), np.int64), *found_keys], axis=1)
            for sample in range(SAMPLES):
                keys[kind, walk, sample] = _table(own[sample], places)
        for steps in EARLY:  # what keys of the classes of more steps begin with
            longer = [places for kind, found in by_class.items() if CLASSES[kind][1] > steps for places in found]
            if longer:
                early[walk, steps] = _beginnings(data, np.concatenate(longer), steps, walk)
    short = {}
    for size, found in by_size.items():
        found.sort(key=lambda x: x[1])
        short[size] = np.array([h for _, h in found], np.int64), np.array([i for i, _ in found], np.int64)
    return Index(ids, texts, data, at, keys, early, {}, short)


def _prefix_hash(text: bytes) -> np.int64:
    """A number for a run of bytes, one after another."""
    total = np.zeros(1, np.int64)
    for c in text:
        total *= _ODD
        total += c + 1
    return total[0]


def _short_items(index: Index, data: np.ndarray, n: int, before: int) -> list[tuple[int, int]]:
    """``(item, byte)`` of the short items that begin in the first ``n`` bytes of ``data`` between word
    borders, exactly as they are."""
    gap, solid = (data == 32) | (data == 0), _ALNUM[data]
    edge = np.ones(len(data) + 1, bool)  # no word goes on over this place
    edge[1:-1] = ~(solid[:-1] & solid[1:])
    edge[0] = not (_ALNUM[before] and len(data) and solid[0])
    wide = data >= 0xE0
    edge[:-1] |= wide                    # signs of three bytes are words by themselves
    edge[3:] |= wide[:-2]
    starts = np.flatnonzero(edge[:n] & ~gap[:n] & ((data[:n] & 0xC0) != 0x80))
    padded = np.concatenate([data, np.zeros(max(index.short) + 1, np.uint8)]).astype(np.int64)
    total, out = np.zeros(len(starts), np.int64), []
    for size in range(1, max(index.short) + 1):
        total *= _ODD
        total += np.take(padded, starts + (size - 1)) + 1
        if size not in index.short:
            continue
        hashes, items = index.short[size]
        left, right = np.searchsorted(hashes, total, "left"), np.searchsorted(hashes, total, "right")
        for k in np.flatnonzero(right > left):
            s = int(starts[k])
            if s + size <= len(data) and edge[s + size]:
                out += [(int(i), s) for i in items[left[k]:right[k]] if data[s:s + size].tobytes() == index.texts[i]]
    return out


def byte_masks(item: bytes) -> dict[int, int]:
    """For every byte, the places at which it stands in ``item``, as bits."""
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def edit_distance_within(
    item: bytes, region: bytes, masks: dict[int, int] | None = None, most: int | None = None
) -> tuple[int, int]:
    """Fewest edits between ``item`` and any stretch of ``region``, and where that ends.

    Myers' bit-parallel dynamic programme (1999): a column of the table is two numbers
    whose bits say where it goes up and where it goes down.  With ``most`` it ends as soon as
    the rest of the region is too short to come down to so few.
    """
    masks = byte_masks(item) if masks is None else masks
    full, last = (1 << len(item)) - 1, 1 << len(item) - 1
    up, down, edits = full, 0, len(item)
    best, left = (edits, 0), len(region) + (len(item) if most is None else most)
    for end, c in enumerate(region, 1):
        same = masks.get(c, 0)
        across = (((same & up) + up) ^ up) | same
        rise, fall = down | (full & ~(across | up)), up & across
        if rise & last:
            edits += 1
            if edits + end > left and best[0] > left - len(region):
                break
        elif fall & last:
            edits -= 1
            if edits < best[0]:
                best = (edits, end)
        along = same | down
        rise, fall = rise << 1 & full, fall << 1 & full
        up, down = fall | (full & ~(along | rise)), rise & along
    return best


def _verified(
    index: Index, data: np.ndarray, at: np.ndarray, hits: list[tuple[int, int, int]], max_ratio: float
) -> list[tuple[int, int, int, int, int]]:
    """``(row, item, edits, start, end)`` of the hits ``(row, item, start)`` within the limit; exact
    copies first, as nothing is nearer than one."""
    out, exact, masks = [], set(), index.masks
    for row, item, start in hits:
        text, here = index.texts[item], at[row] + start
        if start >= 0 and data[here:min(here + len(text), at[row + 1])].tobytes() == text:
            out.append((row, item, 0, start, start + len(text)))
            exact.add((row, item))
    for row, item, start in hits:
        if (row, item) in exact:
            continue
        text = index.texts[item]
        if item not in masks:
            masks[item] = byte_masks(text)
        most = int(max_ratio * len(text))
        lo = max(start - most - DIAGONAL, 0)
        region = data[at[row] + lo:min(at[row] + start + len(text) + most + DIAGONAL, at[row + 1])].tobytes()
        edits, end = edit_distance_within(text, region, masks[item], most)
        if edits <= most:
            out.append((row, item, edits, max(start, 0), lo + end))
    return out


def search(index: Index, column: pa.Array, max_ratio: float):
    """``(row, item, edits, start, end)``: the best place of every item found in a batch of texts."""
    data, at = normal(column)
    for i, j in row_slices(at, SLICE):
        base, stop = int(at[i]), int(at[j])
        found: list[tuple[int, int, int, int, int]] = []
        # a part of a long text ends with enough of what follows for its last walks
        for lo in range(base, stop, SLICE if j - i == 1 else max(stop - base, 1)):
            hi = stop if j - i > 1 else min(lo + SLICE, stop)
            part = data[lo:min(hi + 256, stop)]
            before = int(data[lo - 1]) if lo > base else 0
            hits = _hits(index, data, at, part, lo, hi - lo, before)
            found += _verified(index, data, at, [(row, item, start) for (row, item, _), start in hits.items()], max_ratio)
            if index.short:
                for item, place in _short_items(index, part, hi - lo, before):
                    row = int(np.searchsorted(at, lo + place, "right")) - 1
                    start = lo + place - int(at[row])
                    found.append((row, item, 0, start, start + len(index.texts[item])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for row, item, *place in found:
            best[row, item] = min(best.get((row, item), tuple(place)), tuple(place))
        for (row, item), (edits, start, end) in best.items():
            yield row, item, edits, start, end


def _hits(
    index: Index, data: np.ndarray, at: np.ndarray, part: np.ndarray, lo: int, n: int, before: int
) -> dict[tuple[int, int, int], int]:
    """``(row, item, diagonal)``, and where the item would begin, of windows that share a key."""
    hits: dict[tuple[int, int, int], int] = {}
    starts = window_starts(part, before)
    starts = starts[starts < n]
    if not index.keys or not len(starts):
        return hits
    for walk in range(WALKS):
        met: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for kind, walked, keys in _keys(part, starts, index.classes, walk, index.early):
            for sample in range(SAMPLES):
                known, places, mark = index.keys[kind, walk, sample]
                some = np.flatnonzero(mark[_slots(keys[sample], len(mark))])
                left = np.searchsorted(known, keys[sample][some], "left")
                same = np.flatnonzero(np.take(known, left, mode="clip") == keys[sample][some])
                some, left = some[same], left[same]
                many = np.searchsorted(known, keys[sample][some], "right") - left
                if many.any():
                    found = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    met.setdefault(kind, []).append((np.repeat(walked[some], many), places[found]))
        for kind, pairs in met.items():
            both = np.unique(np.concatenate([h * len(index.data) + t for h, t in pairs]))
            here, there = both // len(index.data), both % len(index.data)
            agreed = _agreement(part, here, index.data, there, kind, walk) >= CLASSES[kind][3]
            here, there = here[agreed] + lo, there[agreed]
            rows, items = np.searchsorted(at, here, "right") - 1, np.searchsorted(index.at, there, "right") - 1
            firsts = here - at[rows] - (there - index.at[items])
            for row, item, first in zip(rows.tolist(), items.tolist(), firsts.tolist()):
                hits.setdefault((row, item, first // DIAGONAL), first)
    return hits


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", max_ratio: float = MAX_RATIO, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(id_col, item_col, edits, item_bytes, start, end, text_hash)``: items within ``max_ratio``
    edits per byte of a stretch of a document; the best place of each item in each row.

    Texts are compared in lower case with runs of white space as one space, in bytes;
    ``start`` and ``end`` are bytes of that form, ``text_hash`` is the document's xxhash64.
    Null and empty texts hold nothing.  Items of under 24 bytes are found where they stand
    exactly, between word borders.  Null and empty items are in no text; an item that is
    listed twice is one, and one id with two texts is two.  Repeated rows and null ids each
    give rows of their own.  Nothing depends on ``block_bytes``.  Other columns are ignored;
    without documents or items there are no rows.
    """
    if id_col == item_col:
        raise ValueError("id_col and item_col must differ")
    spark = docs.sparkSession
    closed = F.concat(F.lower(F.col(f"`{text_col}`")), F.lit("\u0000"))
    listed = items.select(
        F.col(f"`{item_col}`").alias("id"), F.concat(F.lower(F.col(f"`{item_text_col}`")), F.lit("\u0000")).alias("text")
    ).where("text is not null").distinct()
    total = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    schema = [
        field(docs, id_col), field(items, item_col), T.StructField("edits", T.IntegerType()),
        T.StructField("item_bytes", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("text_hash", T.LongType()),
    ]
    kinds = {item_col: listed.select("id").limit(0).toArrow().schema.field("id").type}

    def part(shipped) -> DataFrame:
        held: list[Index] = []

        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            if not held:  # made anew for every task, so that no worker keeps it
                held.append(build_index(shipped.value["id"].to_pylist(), shipped.value["text"].combine_chunks()))
            index = held[0]
            found = []
            for i, j in row_slices(flat(batch.column(1))[1], PART):
                for row, *rest in search(index, batch.column(1).slice(i, j - i), max_ratio):
                    found.append((i + row, *rest))
            if not found:
                return None
            row, item, edits, start, end = zip(*found)
            return pa.RecordBatch.from_arrays([
                pc.take(batch.column(0), pa.array(row)), pa.array([index.ids[i] for i in item], kinds[item_col]),
                pa.array(edits, pa.int32()), pa.array([len(index.texts[i]) for i in item], pa.int32()),
                pa.array(start, pa.int64()), pa.array(end, pa.int64()), pc.take(batch.column(2), pa.array(row)),
            ], [f.name for f in schema])

        rows = docs.select(F.col(f"`{id_col}`").alias("id"), closed.alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
        return map_batches(rows, run, schema)

    out = None
    for b in range(blocks):  # a block's text is bounded
        block = listed.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).orderBy("id", "text").toArrow()
        if not block.num_rows:
            continue
        found = part(spark.sparkContext.broadcast(block))
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], T.StructType(schema)) if out is None else out


def without_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which an item was found, whether they have an id or not; rows
    of the same id that hold no item stay."""
    found = leaks.select(F.col(f"`{id_col}`").alias("id"), "text_hash").distinct()
    same = docs[f"`{id_col}`"].eqNullSafe(found["id"]) & (F.xxhash64(docs[f"`{text_col}`"]) == found["text_hash"])
    return docs.join(found, same, "left_anti")
