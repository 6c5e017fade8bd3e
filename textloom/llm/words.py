"""Texts cut into words that no token reaches over, and every distinct word encoded once.

A text is cut before a single space or line feed between two signs that are surely not
white space.  Byte-level and piece vocabularies without a token that goes on over such a
place (``spans_words`` looks for one) encode the words one by one as they encode the
whole text.  A worker process remembers the words it has seen, over tasks as well, up to
a bound; then it starts anew.  Results never depend on what is remembered.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

KEPT_WORDS = 300_000      # words that a table remembers
KEPT_BYTES = 16 << 20     # and their bytes, whatever their number
JOINED_BYTES = 64 << 10   # words handed to the library as one text

_SOLID = np.zeros(256, bool)      # a byte that is a sign by itself and not white space
_SOLID[0x21:0x7F] = True
_TWO = np.zeros(256, bool)        # first byte of a sign of two bytes; white space has 0xC2
_TWO[0xC3:0xE0] = True
_THREE = np.zeros(256, bool)      # of three bytes; white space has 0xE1 to 0xE3
_THREE[0xE0] = _THREE[0xE4:0xEF] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


def cut(data: np.ndarray, offsets: np.ndarray, marks: bytes = b"") -> np.ndarray:
    """Where words start: at every row that is not empty, and at the places between.

    With ``marks`` also between an ASCII letter and one of these signs, for vocabularies
    whose pre-tokeniser ends a run of letters there.
    """
    n = len(data)
    start = np.zeros(n, bool)
    if n > 2:
        gap = (data == 0x20) | (data == 0x0A)
        solid = _SOLID[data]
        before = solid[:-2].copy()
        before[1:] |= _TWO[data[:-3]]
        if n > 3:
            before[2:] |= _THREE[data[:-4]]
        start[1:-1] = gap[1:-1] & before & (solid | _TWO[data] | _THREE[data])[2:]
    if marks and n:
        end = np.zeros(256, bool)
        end[list(marks)] = True
        start[1:] |= _LETTER[data[:-1]] & end[data[1:]]
    lo, hi = offsets[:-1], offsets[1:]
    full = hi > lo
    start[hi[full] - 1] = False  # a last white space belongs to the word before it
    start[lo[full]] = True
    return np.flatnonzero(start)


def as_words(data: np.ndarray, starts: np.ndarray) -> pa.LargeBinaryArray:
    """The words as an Arrow column over the same bytes."""
    at = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])


def per_process(key: str, make: Callable):
    """``make()``, once for each worker process and key.  A function's own globals are made
    anew for every task, so what is kept lies in a module of its own."""
    kept = sys.modules.setdefault("_textloom_kept", types.ModuleType("_textloom_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def digest(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()[:16]


class Rows:
    """Lists of numbers, added in blocks: list i is ``items[at[i]:at[i + 1]]``."""

    def __init__(self, kind: type = np.int32):
        self.items, self.at, self.n, self.used = np.zeros(1 << 16, kind), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, items: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(items) > len(self.items):
            self.items = np.concatenate([self.items, np.zeros_like(self.items)])
        while self.n + len(sizes) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.items[self.used:self.used + len(items)] = items
        self.at[self.n + 1:self.n + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.used, self.n = self.used + len(items), self.n + len(sizes)

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.at[rows + 1] - self.at[rows]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items of the given lists end to end, and each list's size."""
        sizes = self.sizes(rows)
        first = np.repeat(self.at[rows] - (np.cumsum(sizes) - sizes), sizes)
        return self.items[first + np.arange(len(first))], sizes

    def only(self, rows: np.ndarray) -> Rows:
        """The given lists alone."""
        made = Rows(self.items.dtype)
        made.add(*self.of(rows))
        return made


class WordTable:
    """Codes of words; ``learn`` gets the list of words that are new, ``forget`` the codes that stay
    when the table starts anew: code ``kept[i]`` is ``i`` from then on."""

    def __init__(
        self, learn: Callable[[list[bytes]], None], forget: Callable[[np.ndarray], None], most: int = KEPT_WORDS, most_bytes: int = KEPT_BYTES
    ):
        self.learn, self.forget, self.most, self.most_bytes = learn, forget, most, most_bytes
        self.known, self.size = {}, 0
        self.asked = np.zeros(0, np.uint8)  # how often each word was asked for, at most 255 times

    def full(self) -> bool:
        """Whether there are too many words, or too many bytes of them."""
        return len(self.known) > self.most or self.size > self.most_bytes

    def reset_if_full(self) -> bool:
        """Start anew once the table is full, with the words asked for most often if they take half of
        it at most; codes given before lose their meaning."""
        if not self.full():
            return False
        asked = self.asked[:len(self.known)]
        words = list(self.known)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        fits = [  # for every number of times: whether the words asked for more often take half of the table at most
            n <= self.most // 2 and size <= self.most_bytes // 2
            for n, size in zip(*(np.cumsum(np.bincount(asked, w, 257)[:0:-1])[::-1] for w in (None, sizes)))
        ]
        kept = np.flatnonzero(asked > max(fits.index(True), 1))
        self.known = {words[c]: i for i, c in enumerate(kept.tolist())}
        self.size = sum(map(len, self.known))
        self.asked = np.zeros(len(kept), np.uint8)
        self.forget(kept)
        return True

    def codes(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """``(codes, places)``: the code of each distinct word, and for every word the place
        of its code in ``codes``."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known
        found = np.fromiter(map(known.get, distinct, itertools.repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown.tolist()]
            found[unknown] = np.arange(len(known), len(known) + len(new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.size += sum(map(len, new))
            self.learn(new)
        if len(known) > len(self.asked):
            self.asked = np.concatenate([self.asked, np.zeros(max(len(self.asked), len(known) - len(self.asked)), np.uint8)])
        self.asked[found] += self.asked[found] < 255
        return found, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


# --- byte-level vocabularies of the tokenizers library -------------------------------------


def byte_alphabet() -> dict[str, int]:
    """The signs that stand for bytes in a byte-level vocabulary: printable bytes stand for
    themselves, the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level tokenizer: ids of words, and the bytes of every id."""

    def __init__(self, vocabulary: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = special_as_text
        signs = byte_alphabet()
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.bytes_of = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.bytes_of[i] = token.encode() if token in added else bytes(signs[c] for c in token)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        inside = "".join(added)
        # signs that end a run of letters; those of special tokens may stand inside one
        self.marks = bytes(ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[]^_`{}~" if c not in inside)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and each word's number of ids.

        Words that begin with one white space and end in a sign that is none are
        handed over side by side as one text; their borders are found again by the
        bytes of the ids, and words are encoded singly if one should not be there.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        joined = _joined(words, lengths)
        order, alone = np.flatnonzero(joined), [np.flatnonzero(~joined)]
        parts, sizes, places = [], [], []
        block = (np.cumsum(lengths[order]) - 1) // JOINED_BYTES
        for batch in np.split(order, np.flatnonzero(np.diff(block)) + 1):
            ids, _ = self._encode([b"".join([words[i] for i in batch.tolist()]).decode()])
            ends, want = np.cumsum(self.lengths[ids]), np.cumsum(lengths[batch])
            at = np.searchsorted(ends, want)
            if len(ends) and ends[-1] == want[-1] and (ends[np.minimum(at, len(ends) - 1)] == want).all():
                parts.append(ids)
                sizes.append(np.diff(at, prepend=-1))
                places.append(batch)
            else:
                alone.append(batch)
        single = np.concatenate(alone)
        for lo in range(0, len(single), 4096):
            batch = single[lo:lo + 4096]
            ids, n = self._encode([words[i].decode() for i in batch.tolist()])
            parts.append(ids)
            sizes.append(n)
            places.append(batch)
        return _in_order(parts, sizes, places)


def _joined(words: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Which words begin and end as words do that ``cut`` has cut on both sides: with one white space
    before a sign that is none, and with such a sign."""
    data = np.frombuffer(b"\0\0\0" + b"".join(words) + b"\0", np.uint8)
    lo = np.cumsum(lengths) - lengths + 3
    last = lo + lengths - 1
    first, after, before = data[lo], data[lo + 1], data[last]
    ended = _SOLID[before] | (_TWO[data[last - 1]] & (lengths > 2)) | (_THREE[data[last - 2]] & (lengths > 3))
    begun = ((first == 0x20) | (first == 0x0A)) & (_SOLID[after] | _TWO[after] | _THREE[after])
    return begun & ended & (lengths > 1)


def _in_order(parts: list[np.ndarray], sizes: list[np.ndarray], places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lists that lie end to end in ``parts``, put at their places; and each one's size."""
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    items, found, at = np.concatenate(parts), np.concatenate(sizes), np.concatenate(places)
    size, begin = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    size[at], begin[at] = found, np.cumsum(found) - found
    if (at[1:] > at[:-1]).all():
        return items, size
    return items[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(items))], size


# --- piece vocabularies of the sentencepiece library ---------------------------------------

GAP = "▁"  # fixed value: how pieces write a space


class Pieces:
    """A piece tokenizer that puts a space before every text: ids of words, and the bytes of
    every id."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = len(self.model)
        self.bytes_of = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace(GAP, " ").encode() for i in range(n)
        ]
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(n)])
        self.feed = self.model.encode("\n")  # the space put before a text, and the line feed

    def spans_words(self) -> bool:
        """Whether a piece goes on over a space or holds a line feed, so that words cannot be
        encoded one by one."""
        pieces = [self.model.id_to_piece(i) for i in range(len(self.model)) if not self.is_byte[i]]
        return any("\n" in p or any(p[k] == GAP != p[k - 1] for k in range(1, len(p))) for p in pieces)

    def ends_letters(self, marks: bytes) -> bytes:
        """Those of ``marks`` that follow a letter in no piece, so that words can end before them."""
        pieces = [p for i, p in enumerate(map(self.model.id_to_piece, range(len(self.model)))) if not self._control(i)]
        after = {p[k] for p in pieces for k in range(1, len(p)) if p[k - 1].isascii() and p[k - 1].isalpha()}
        return bytes(m for m in marks if chr(m) not in after)

    def _control(self, i: int) -> bool:
        return self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A word without a space before it is encoded after a line feed, which joins nothing."""
        texts, drop = [], []
        for w in words:
            first = w[:1]
            texts.append((w[1:] if first == b" " else w if first == b"\n" else b"\n" + w).decode())
            drop.append(0 if first == b" " else 1 if first == b"\n" else 2)
        ids = self.model.encode(texts, num_threads=1)
        for i, n in enumerate(drop):
            if n:
                if ids[i][:2] != self.feed:
                    raise ValueError("the vocabulary joins a line feed to what stands beside it")
                ids[i] = ids[i][n:]
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes
