"""Token ids in binary files: one id array, document boundaries in Elias-Fano code.

A file holds consecutive documents in ascending order of their ids.  Layout, all numbers
little-endian:

    8 bytes   magic
    header    width of an id, documents, documents without an id, range, file of the range,
              number of ids, smallest document id
    ids       the documents' token ids end to end, 2 or 4 bytes each
    ends      Elias-Fano code of where each document ends, counted in ids from the file's start
    names     Elias-Fano code of the document ids, counted from the smallest

An Elias-Fano code of n ascending numbers below u keeps the lowest log2(u / n) bits of each
number as they are and the rest as a bit row in which number i sets bit ``(x >> low) + i``:
at most 2 bits a number more than the logarithm, and no table of 64-bit offsets.  Number i
is found by selecting the i-th set bit from the nearest of the sampled places.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from textloom.llm.batches import field, flat, narrow, row_slices
from textloom.llm.words import ByteLevel, Rows, WordTable, as_words, cut, digest, per_process
from textloom.plans import durable, with_running_total

MAGIC = b"TOKENS01"
HEAD = "<BIIIIQq"
FILE_IDS = 4 << 20   # a file is closed once it holds so many ids; the last document is kept whole
FILE_DOCS = 1 << 20  # or so many documents
SLICE_BYTES = 2 << 20  # texts encoded at once: the distinct words of a slice are looked up
SAMPLE = 256         # every so many set bits the place of one is kept
_EF = "<IQB"


# --- Elias-Fano codes ------------------------------------------------------------------------


def ef_encode(values: np.ndarray) -> bytes:
    """The code of ascending numbers (``uint64``)."""
    n = len(values)
    largest = int(values[-1]) if n else 0
    low = min(63, max(0, ((largest + 1) // n).bit_length() - 1)) if n else 0
    rest = np.zeros((n, low), np.uint8)
    for k in range(low):
        rest[:, k] = (values >> np.uint64(k)) & np.uint64(1)
    places = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    bits[places] = 1
    return b"".join([
        struct.pack(_EF, n, largest, low), np.packbits(rest.ravel(), bitorder="little").tobytes(),
        places[::SAMPLE].astype("<u4").tobytes(), np.packbits(bits, bitorder="little").tobytes(),
    ])


class EliasFano:
    """Reads a code in place; ``end`` is where it ends in ``data``."""

    def __init__(self, data: memoryview | bytes, at: int = 0):
        self.n, self.largest, self.low = struct.unpack_from(_EF, data, at)
        at += struct.calcsize(_EF)
        size = (self.n * self.low + 7) // 8
        self._rest = np.frombuffer(data, np.uint8, size, at)
        at += size
        samples = -(-self.n // SAMPLE)
        self._samples = np.frombuffer(data, "<u4", samples, at)
        at += 4 * samples
        size = (self.n + (self.largest >> self.low) + 7) // 8 if self.n else 0
        self._bits = np.frombuffer(data, np.uint8, size, at)
        self.end = at + size

    def __getitem__(self, i: int) -> int:
        """Number ``i``: the sampled place before it, then at most ``SAMPLE`` set bits further."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, ahead = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte, skipped = at // 8, at % 8
        ahead += int(self._bits[byte] & ((1 << skipped) - 1)).bit_count()
        while True:
            ones = int(self._bits[byte]).bit_count()
            if ahead < ones:
                break
            ahead, byte = ahead - ones, byte + 1
        place = byte * 8 + int(np.flatnonzero(np.unpackbits(self._bits[byte:byte + 1], bitorder="little"))[ahead])
        bit = i * self.low
        window = np.unpackbits(self._rest[bit // 8:(bit + self.low + 7) // 8], bitorder="little")[bit % 8:bit % 8 + self.low]
        return (place - i << self.low) | sum(int(b) << k for k, b in enumerate(window))

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self._bits, bitorder="little"))
        rest = np.unpackbits(self._rest, count=self.n * self.low, bitorder="little").reshape(self.n, self.low)
        out = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        for k in range(self.low):
            out |= rest[:, k].astype(np.uint64) << np.uint64(k)
        return out


# --- files -------------------------------------------------------------------------------------


def _file(width: int, part: int, seq: int, ids: np.ndarray, ends: np.ndarray, names: pa.Array) -> bytes:
    known = names.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    first = int(known[0]) if len(known) else 0
    # differences of 64-bit ids fit 64 bits without a sign
    names_code = ef_encode(known.view(np.uint64) - np.array(first, np.int64).view(np.uint64))
    head = struct.pack(HEAD, width, len(ends), names.null_count, part, seq, len(ids), first)
    # the ids are joined from where they lie: a worker holds them once beside the file
    return b"".join([MAGIC, head, ids.astype(f"<u{width}", copy=False).data, ef_encode(ends.astype(np.uint64)), names_code])


class TokenFile:
    """One file's content: ids, boundaries, document ids."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a file of token ids")
        width, self.n_docs, self.n_null, self.part, self.seq, n, self.first = struct.unpack_from(HEAD, content, 8)
        at = 8 + struct.calcsize(HEAD)
        self.ids = np.frombuffer(content, f"<u{width}", n, at)
        self.ends = EliasFano(content, at + n * width)
        self._names = EliasFano(content, self.ends.end)

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i`` of this file."""
        return self.ids[self.ends[i - 1] if i else 0:self.ends[i]]

    def names(self) -> pa.Array:
        known = (self._names.all() + np.array(self.first, np.int64).view(np.uint64)).view(np.int64)
        return pa.concat_arrays([pa.nulls(self.n_null, pa.int64()), pa.array(known, pa.int64())])


class _Encoder:
    """Ids of whole texts, by their distinct words; kept by a worker for as long as it lives."""

    def __init__(self, vocabulary: str):
        self.library = ByteLevel(vocabulary)
        self.table = WordTable(self._learn, self._forget)
        self.rows = Rows(np.int32)

    def _forget(self, kept: np.ndarray) -> None:
        self.rows = self.rows.only(kept)

    def _learn(self, new: list[bytes]) -> None:
        self.rows.add(*self.library.encode(new))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and where each row ends."""
        self.table.reset_if_full()
        starts = cut(data, offsets, self.library.marks)
        codes, places = self.table.codes(as_words(data, starts))
        ids, sizes = self.rows.of(codes[places])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, ends[np.searchsorted(starts, offsets[1:])]


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    file_ids: int = FILE_IDS, slice_bytes: int = SLICE_BYTES,
) -> str:
    """Every whole text's ids and ``end_id``, in files of about ``file_ids`` ids under ``path``.

    ``vocabulary`` is the content of a byte-level tokenizer's JSON file; special tokens are
    neither added nor hidden.  Documents stand in ascending order of their id (a whole
    number), those without an id first, rows of one id in the order of a hash of their
    text; ranges of ids are dealt by samples of (id, hash), so an id may repeat without limit.
    A null text counts as empty and has the end id alone; every row is written once; an
    empty table gives no file.  Files are written by Spark's own committer, one row of
    bytes each, so a lost task leaves nothing behind, to any store that Spark can write;
    a file ends in one line feed that is not part of its content.
    """
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{id_col} must be a whole number")
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(vocabulary)
    key = f"token-files-{digest(vocabulary.encode())}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(key, lambda: _Encoder(shipped.value))
        width = 2 if max(len(encoder.library.bytes_of) - 1, end_id) < 1 << 16 else 4
        kind = np.uint16 if width == 2 else np.uint32
        part, seq = TaskContext.get().partitionId(), 0
        ids, ends, names, n = [], [], [], 0

        def closed() -> pa.RecordBatch:
            whole = np.concatenate(ids)
            ids.clear()  # else they lie in memory twice while the file is made
            blob = _file(width, part, seq, whole, np.concatenate(ends), pa.chunked_array(names).combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["file"])

        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            data, at = flat(texts)
            for i, j in row_slices(at, slice_bytes):
                found, stops = encoder.encode(data[at[i]:at[j]], at[i:j + 1] - at[i])
                ids.append(np.insert(found.astype(kind), stops, end_id))
                ends.append(n + stops + np.arange(1, j - i + 1))
                names.append(batch.column(0).slice(i, j - i).cast(pa.int64()))
                n += len(ids[-1])
                if n >= file_ids or sum(map(len, ends)) >= FILE_DOCS:
                    yield closed()
                    ids, ends, names, n, seq = [], [], [], 0, seq + 1
        if ids:
            yield closed()
        pa.default_memory_pool().release_unused()  # workers live on after their task

    rows = narrow(docs, id=id_col, text=text_col).withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.col("id").asc_nulls_first(), "tie", "row"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    files = sorted_rows.mapInArrow(run, "file binary")
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    return path


def _parsed(spark: SparkSession, path: str, of_file, schema: str) -> DataFrame:
    """``of_file`` over the content of every file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield of_file(TokenFile(content.as_buffer().to_pybytes()))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    return files.select("content").mapInArrow(run, schema)


def _spans(f: TokenFile) -> tuple[np.ndarray, np.ndarray]:
    ends = f.ends.all().astype(np.int64)
    return np.concatenate([[0], ends[:-1]]).astype(np.int64), ends


def read_boundaries(spark: SparkSession, path: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document, from the files alone.

    ``start`` counts the ids of all documents before it, over all files: the files' lengths are
    added up by their place in the order of documents.
    """

    def rows(f: TokenFile) -> pa.RecordBatch:
        starts, ends = _spans(f)
        wide = f.ids.astype("<u4")
        sums = [zlib.crc32(wide[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        n = f.n_docs
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, f.part), pa.int32()), pa.array(np.full(n, f.seq), pa.int32()), f.names(),
             pa.array(starts), pa.array(ends - starts), pa.array(sums, pa.int64())],
            ["part", "seq", "id", "at", "n", "crc"],
        )

    found = durable(_parsed(spark, path, rows, "part int, seq int, id bigint, at bigint, n bigint, crc bigint"), "boundaries")
    lengths = found.groupBy("part", "seq").agg(F.sum("n").alias("ids"))
    bases = with_running_total(lengths, "ids", "part", "seq", name="base").select("part", "seq", "base")
    return found.join(bases, ["part", "seq"]).select(
        F.col("id").cast(id_type).alias(id_col), (F.col("base") + F.col("at")).alias("start"),
        F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"),
    )


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """``(id_col, input_ids)``: every document's ids, the end id included."""

    def rows(f: TokenFile) -> pa.RecordBatch:
        _, ends = _spans(f)
        at = pa.array(np.concatenate([[0], ends]), pa.int64())
        lists = pa.LargeListArray.from_arrays(at, pa.array(f.ids.astype(np.int32))).cast(pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([f.names(), lists], ["id", "input_ids"])

    return _parsed(spark, path, rows, "id bigint, input_ids array<int>").select(F.col("id").cast(id_type).alias(id_col), "input_ids")
