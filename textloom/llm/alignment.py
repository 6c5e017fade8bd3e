"""Two tokenizers' ids on the same bytes: groups between common borders, counts of linked ids.

Where a token of A and a token of B end at the same byte, both sequences are cut into
groups; inside a group every pair of tokens that share a byte is linked.  Texts are cut
into words that no token of either side reaches over, so groups never do, and each
distinct word is aligned once per worker.

Identity-map fast path: an array from every id of A to the id of B with the same bytes.
Groups of one token on each side that the array foretells are counted in a vector of the
vocabulary's length, one per task; only the pairs of the other, irregular groups are
added up pair by pair before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from textloom.llm.batches import SLICE_BYTES, field, flat, narrow, row_slices, sums
from textloom.llm.words import ByteLevel, Pieces, Rows, WordTable, as_words, cut, digest, per_process
from textloom.plans import durable, lookup_join

MAX_PAIRS = 4 << 20    # pairs ever shipped to the workers (17 bytes each); beyond it they are joined
_WORDS = 1 << 16       # words whose links are listed at a time
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Both tokenizers, and the tokens of all words seen; kept by a worker as long as it lives."""

    def __init__(self, vocabulary: str, model: bytes):
        self.a, self.b = ByteLevel(vocabulary, special_as_text=True), Pieces(model)
        self.whole = self.b.spans_words()  # then every text is one word
        self.marks = self.b.ends_letters(self.a.marks)
        self.size_b = len(self.b.bytes_of)
        self.identity = identity_map(self.a, self.b)
        self.table = WordTable(self._learn, self._forget)
        self.ids_a, self.ids_b, self.good, self.texts = Rows(np.int32), Rows(np.int32), Rows(np.bool_), []

    def _forget(self, kept: np.ndarray) -> None:
        self.ids_a, self.ids_b, self.good = self.ids_a.only(kept), self.ids_b.only(kept), self.good.only(kept)
        self.texts = [self.texts[c] for c in kept[kept < len(self.texts)].tolist()]

    def _learn(self, words: list[bytes]) -> None:
        a, na = self.a.encode(words)
        b, nb = self.b.encode(words)
        whole = b"".join(words)
        sizes = np.array([len(w) for w in words], np.int64)
        good = np.ones(len(words), bool)
        for ids, n, side in ((a, na, self.a), (b, nb, self.b)):
            row = np.repeat(np.arange(len(words)), n)
            good &= np.bincount(row, side.lengths[ids], len(words)).astype(np.int64) == sizes
            if b"".join([side.bytes_of[i] for i in ids.tolist()]) != whole:
                ends = np.cumsum(n)
                for k, w in enumerate(words):
                    good[k] &= b"".join([side.bytes_of[i] for i in ids[ends[k] - n[k]:ends[k]].tolist()]) == w
        self.ids_a.add(a[np.repeat(good, na)], np.where(good, na, 0))
        self.ids_b.add(b[np.repeat(good, nb)], np.where(good, nb, 0))
        self.good.add(good, np.ones(len(words), np.int64))

    def links(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(word, a, b, alone, last)`` of all links of the given words, in the order of their
        bytes: a run of bytes between neighbouring borders of either side is one link.
        ``alone``: the link is its whole group; ``last``: it ends its group."""
        a, na = self.ids_a.of(codes)
        b, nb = self.ids_b.of(codes)
        ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        last = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        alone = last.copy()
        alone[1:] &= last[:-1]
        return np.repeat(np.arange(len(codes)), na)[at_a], a[at_a], b[at_b], alone, last

    def sizes(self, codes: np.ndarray) -> np.ndarray:
        """Tokens of A, tokens of B, groups and links of each word."""
        out = np.zeros((len(codes), 4), np.int64)
        for lo in range(0, len(codes), _WORDS):
            part = codes[lo:lo + _WORDS]
            word, _, _, _, last = self.links(part)
            n = len(part)
            out[lo:lo + n] = np.column_stack([
                self.ids_a.sizes(part), self.ids_b.sizes(part), np.bincount(word[last], minlength=n), np.bincount(word, minlength=n),
            ])
        return out

    def write_groups(self) -> None:
        """Group texts of all words that have none yet: ``a1,a2|b1;a3|b2``."""
        for lo in range(len(self.texts), self.good.n, _WORDS):
            codes = np.arange(lo, min(lo + _WORDS, self.good.n))
            a, na = self.ids_a.of(codes)
            b, _ = self.ids_b.of(codes)
            ends_a, ends_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
            common = np.intersect1d(ends_a, ends_b, assume_unique=True)
            to_a, to_b = np.searchsorted(ends_a, common) + 1, np.searchsorted(ends_b, common) + 1
            names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            groups, i, j = [], 0, 0
            for p, q in zip(to_a.tolist(), to_b.tolist()):
                groups.append(f"{names_a[i]}|{names_b[j]}" if p - i == q - j == 1 else f"{','.join(names_a[i:p])}|{','.join(names_b[j:q])}")
                i, j = p, q
            stops = np.searchsorted(to_a, np.cumsum(na), "right").tolist()  # groups up to the end of each word
            k = 0
            for stop in stops:
                self.texts.append(";".join(groups[k:stop]))
                k = stop

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(codes, places, starts, good)``: distinct words of the texts, the place of every word
        in ``codes``, the first word of every text, and whether the text has tokens."""
        data, at = flat(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        begins = at[:-1] if self.whole else cut(data, at, self.marks)
        codes, places = self.table.codes(as_words(data, begins))
        starts = np.searchsorted(begins, at)
        fine = self.good.items[self.good.at[codes]][places]
        return codes, places, starts, sums((~fine).astype(np.int64), starts[:-1], starts[1:]) == 0


def identity_map(a: ByteLevel, b: Pieces) -> np.ndarray:
    """For every id of A the id of B with the same bytes, -1 if there is none; a piece is
    preferred to the sign of a single byte."""
    by_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(b.bytes_of)), key=lambda i: (bool(b.is_byte[i]), i)):
        if not (b.model.is_control(i) or b.model.is_unknown(i) or b.model.is_unused(i)):
            by_bytes.setdefault(b.bytes_of[i], i)
    return np.array([by_bytes.get(x, -1) for x in a.bytes_of], np.int64)


class Tokenizers:
    """The two tokenizers of an alignment, shipped to the workers by their content."""

    def __init__(self, spark, vocabulary: str, model: bytes):
        self._content = spark.sparkContext.broadcast((vocabulary, model))
        self._key = f"alignment-{digest(vocabulary.encode() + model)}"

    def __call__(self) -> Aligner:
        return per_process(self._key, lambda: Aligner(*self._content.value))


def _slices(batch: pa.RecordBatch, slice_bytes: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
    for i, j in row_slices(flat(texts)[1], slice_bytes):
        yield batch.column(0).slice(i, j - i), texts.slice(i, j - i)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their numbers."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], (np.add.reduceat(n, first) if len(first) else n)


def pair_counts(
    docs: DataFrame, tokenizers: Tokenizers, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``(a, b, n, best)``: how many links hold A id ``a`` and B id ``b``, and whether no other A id
    is linked to ``b`` more often.  Stored.

    A task counts its words first and lists the links of each distinct word once; it then
    gives one row for every id of the vector and one for every irregular pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = tokenizers()
        counted = np.zeros(1 << 16, np.int64)

        def pairs() -> Iterator[pa.RecordBatch]:
            vector = np.zeros(len(aligner.identity), np.int64)
            keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
            used = np.flatnonzero(counted)
            for lo in range(0, len(used), _WORDS):
                codes = used[lo:lo + _WORDS]
                word, a, b, alone, _ = aligner.links(codes)
                n = counted[codes][word]
                fast = alone & (aligner.identity[a] == b)
                np.add.at(vector, a[fast], n[fast])
                more = a[~fast].astype(np.int64) * aligner.size_b + b[~fast]
                keys, times = _summed(np.concatenate([keys, more]), np.concatenate([times, n[~fast]]))
            known = np.flatnonzero(vector)
            rows = (
                np.concatenate([known, keys // aligner.size_b]).astype(np.int32),
                np.concatenate([aligner.identity[known], keys % aligner.size_b]).astype(np.int32),
                np.concatenate([vector[known], times]),
            )
            yield from pa.table(list(map(pa.array, rows)), ["a", "b", "n"]).to_batches(max_chunksize=1 << 16)

        for batch in batches:
            for _, texts in _slices(batch, slice_bytes):
                if aligner.table.full():
                    yield from pairs()
                    counted[:] = 0
                    aligner.table.reset_if_full()
                codes, places, starts, good = aligner.words(texts)
                if len(codes) and codes.max() >= len(counted):
                    counted = np.concatenate([counted, np.zeros(max(len(counted), int(codes.max())), np.int64)])
                kept = np.repeat(good, np.diff(starts))
                counted[codes] += np.bincount(places[kept], minlength=len(codes))
        yield from pairs()

    rows = narrow(docs, id=id_col, text=text_col).mapInArrow(run, "a int, b int, n bigint")
    found = durable(rows.groupBy("a", "b").agg(F.sum("n").alias("n")), "pairs")
    top = found.groupBy("b").agg(F.max("n").alias("top"))
    return durable(found.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best")), "pairs")


class _Counts:
    """Counts of pairs, looked up by their key; a pair that is not listed counts nothing."""

    def __init__(self, table: pa.Table, size_b: int):
        keys = table["a"].to_numpy().astype(np.int64) * size_b + table["b"].to_numpy()
        order = np.argsort(keys)
        self.keys, self.n, self.best = keys[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[at] == keys
        return self.n[at] * there, (self.best[at] & there).astype(np.int64)


def align(
    docs: DataFrame, vocabulary: str, model: bytes, id_col: str = "doc_id", text_col: str = "text",
    max_pairs: int = MAX_PAIRS, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every row.

    A is a byte-level tokenizer (content of its JSON file) over a space and the text, B a piece
    tokenizer (content of its model file) that puts the space itself; special tokens are
    plain text.  ``n_best``: links whose count over all rows is the highest of their B id, ties
    included; ``count_sum``: the counts of all links, added up; ``groups``: the ids of every
    group, as ``a1,a2|b1;a3|b2,b3``.  A row has no tokens, zeros and an empty ``groups`` if
    its text is null or empty or one side does not give its bytes back.  Repeated rows and
    null ids each give a row of their own and count each; other columns are ignored; an
    empty table gives an empty one.

    Counts come from a first pass (``pair_counts``).  Up to ``max_pairs`` pairs they are shipped to
    the workers; beyond, only the pairs of the identity map are, as their number is bounded
    by A's vocabulary, and the others are joined to every row's irregular pairs.
    """
    spark = docs.sparkSession
    tokenizers = Tokenizers(spark, vocabulary, model)
    pairs = pair_counts(docs, tokenizers, id_col, text_col, slice_bytes)
    shipped_whole = pairs.count() <= max_pairs
    if shipped_whole:
        counts = spark.sparkContext.broadcast(pairs.toArrow())
    else:
        same = [(a, int(b)) for a, b in enumerate(tokenizers().identity) if b >= 0]
        listed = F.broadcast(spark.createDataFrame(same, "a int, b int"))
        counts = spark.sparkContext.broadcast(pairs.join(listed, ["a", "b"]).toArrow())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = tokenizers()
        known = _Counts(counts.value, aligner.size_b)
        row = TaskContext.get().partitionId() << 33
        stats, have = np.zeros((0, 6), np.int64), np.zeros(0, bool)

        def of_words(codes: np.ndarray) -> np.ndarray:
            nonlocal stats, have
            if aligner.good.n > len(have):
                more = max(len(have), aligner.good.n - len(have))
                stats, have = np.concatenate([stats, np.zeros((more, 6), np.int64)]), np.concatenate([have, np.zeros(more, bool)])
            new = codes[~have[codes]]
            stats[new, :4] = aligner.sizes(new)
            for lo in range(0, len(new), _WORDS):
                part = new[lo:lo + _WORDS]
                word, a, b, _, _ = aligner.links(part)
                n, best = known(a.astype(np.int64) * aligner.size_b + b)
                ends = np.searchsorted(word, np.arange(len(part) + 1))
                stats[part, 4:] = sums(np.column_stack([best, n]), ends[:-1], ends[1:])
            have[new] = True
            return stats[codes]

        for batch in batches:
            for ids, texts in _slices(batch, slice_bytes):
                if aligner.table.reset_if_full():
                    have[:] = False
                codes, places, starts, good = aligner.words(texts)
                own = sums(of_words(codes)[places], starts[:-1], starts[1:]) * good[:, None]
                aligner.write_groups()
                each = [aligner.texts[c] for c in codes.tolist()]
                at, edges = places.tolist(), starts.tolist()
                groups = [";".join([each[k] for k in at[i:j]]) if g else "" for i, j, g in zip(edges, edges[1:], good.tolist())]
                out = [ids, *[pa.array(own[:, k]) for k in range(6)], pa.array(groups, pa.string())]
                if not shipped_whole:
                    numbers = row + np.arange(len(texts))
                    row += len(texts)
                    out += [pa.array(numbers), _open_pairs(aligner, codes, places, starts, good)]
                yield pa.RecordBatch.from_arrays(out, names)

    names = ["id", *COUNTS, "n_best", "count_sum", "groups"]
    fields = [field(docs, id_col, "id"), *[T.StructField(n, T.LongType()) for n in names[1:7]], T.StructField("groups", T.StringType())]
    if not shipped_whole:
        names += ["row", "open"]
        pair = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("times", T.LongType())])
        fields += [T.StructField("row", T.LongType()), T.StructField("open", T.ArrayType(pair))]
    rows = narrow(docs, id=id_col, text=text_col).mapInArrow(run, T.StructType(fields))
    if not shipped_whole:
        rows = _with_open_pairs(durable(rows, "aligned"), pairs)
    return rows.select(F.col("id").alias(id_col), *names[1:8])


def _open_pairs(aligner: Aligner, codes: np.ndarray, places: np.ndarray, starts: np.ndarray, good: np.ndarray) -> pa.Array:
    """Each text's distinct pairs outside the identity map, and how often each is linked."""
    word, a, b, _, _ = aligner.links(codes)
    rest = aligner.identity[a] != b
    word, a, b = word[rest], a[rest], b[rest]
    ends = np.searchsorted(word, np.arange(len(codes) + 1))
    sizes = np.diff(ends)[places]
    first = np.repeat(ends[:-1][places] - (np.cumsum(sizes) - sizes), sizes)
    at = first + np.arange(len(first))
    text = np.repeat(np.repeat(np.arange(len(good)), np.diff(starts)), sizes)
    pairs = a.astype(np.int64) * aligner.size_b + b
    span = len(aligner.identity) * aligner.size_b
    kept = good[text]
    keys, times = _summed(text[kept] * span + pairs[at[kept]], np.ones(int(kept.sum()), np.int64))
    edges = np.searchsorted(keys // span, np.arange(len(good) + 1))
    keys %= span
    items = pa.StructArray.from_arrays(
        [pa.array((keys // aligner.size_b).astype(np.int32)), pa.array((keys % aligner.size_b).astype(np.int32)), pa.array(times)], ["a", "b", "times"]
    )
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), items)


def _with_open_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add what the pairs that were not shipped give to ``n_best`` and ``count_sum``.  A pair's
    count bounds the rows that hold it, so hot pairs are known and dealt over several tasks."""
    asked = rows.select("row", F.inline("open"))
    found = lookup_join(asked, pairs.withColumn("w", F.col("n")), ["a", "b"], "w")
    more = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    return rows.drop("open").join(more, "row", "left").withColumns({
        "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
    })
