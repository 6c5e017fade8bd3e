import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import ODD, SF
from textloom.llm.queries import BYTE_VOCABULARY, END_ID, op12_token_files, vocabulary
from textloom.llm.token_files import _Encoder, EliasFano, TokenFile, ef_encode, read_boundaries, read_tokens, write_token_files
from textloom.llm.words import ByteLevel, WordTable, as_words
from textloom.plans import fresh_path

V = vocabulary(public_tokenizers.path(BYTE_VOCABULARY))
SIGNS = ["a", "b", "é", "日", " ", " ", "\n", " ", "　", ",", ".", "'s", "1", "\t", "<|endoftext|>", "|", "<", "  ", "\x00", "ß", "\u0085", "😀", "\r\n", "word", "The"]


def expected(rows):
    """``[(id, start, n, crc)]`` of rows in their order, by the library on whole texts."""
    t, start, out = Tokenizer.from_str(V), 0, []
    for i, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.sampled_from([1, 5, 300, 2**20, 2**64]))
def test_elias_fano_round_trip(values, below):
    numbers = np.array(sorted(v % below for v in values), np.uint64)
    code = EliasFano(b"xx" + ef_encode(numbers) + b"rest", 2)
    assert code.all().tolist() == numbers.tolist() == [code[i] for i in range(len(numbers))]
    with pytest.raises(IndexError):
        code[len(numbers)]


def test_elias_fano_is_small_and_selects_past_samples():
    rng = np.random.default_rng(5)
    ends = np.cumsum(rng.integers(0, 4000, 20_000)).astype(np.uint64)
    ends[5000:15_000] = ends[5000]  # a long run of empty documents
    ends.sort()
    code = ef_encode(ends)
    assert len(code) * 8 < len(ends) * (np.log2(int(ends[-1]) / len(ends)) + 3)
    read = EliasFano(code)
    for i in [0, 1, 255, 256, 257, 4999, 5000, 9999, 15_000, 19_999]:
        assert read[i] == ends[i]


def test_query_is_the_library_s(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = [tuple(r) for r in op12_token_files(spark, SF).orderBy("doc_id").collect()]
    assert got == expected(rows)


@pytest.mark.parametrize("file_ids", [1, 50, 1 << 20])
def test_files_of_any_size(spark, file_ids):
    rng = random.Random(3)
    rows = [(rng.randrange(-(2**63), 2**63), "".join(rng.choices(SIGNS, k=rng.randrange(30)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = write_token_files(df, fresh_path(spark, "t"), V, END_ID, file_ids=file_ids, slice_bytes=300)
    want = expected(sorted(rows))
    assert [tuple(r) for r in read_boundaries(spark, path).orderBy("doc_id").collect()] == want
    t = Tokenizer.from_str(V)
    ids = {r.doc_id: r.input_ids for r in read_tokens(spark, path).collect()}
    assert ids == {i: [*t.encode(x, add_special_tokens=False).ids, END_ID] for i, x in rows}
    files = [TokenFile(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    assert sum(f.n_docs for f in files) == 300 and all(f.ids.itemsize == 2 for f in files)
    f = max(files, key=lambda f: f.n_docs)
    for i, name in enumerate(f.names().to_pylist()):
        assert f.document(i).tolist() == ids[name]


def test_odd_rows(spark, odd, none):
    path = write_token_files(odd, fresh_path(spark, "t"), V, END_ID, slice_bytes=10_000)
    got = [tuple(r) for r in read_boundaries(spark, path).orderBy("start").collect()]
    plain = {(i, n, c) for i, _, n, c in expected(ODD)}
    assert [g[0] for g in got] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i)) and {(i, n, c) for i, _, n, c in got} == plain
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0
    assert read_boundaries(spark, write_token_files(none, fresh_path(spark, "t"), V, END_ID)).count() == 0
    with pytest.raises(ValueError):
        write_token_files(odd.withColumn("doc_id", odd.key), fresh_path(spark, "t"), V, END_ID)


def test_one_id_and_one_text_without_limit(spark):
    """Half of the rows are the same row: they may lie in any number of ranges."""
    df = spark.range(4000).selectExpr("if(id % 2 = 0, 7, id) as doc_id", "if(id % 2 = 0, 'same text', concat('text ', id)) as text")
    path = write_token_files(df.repartition(8), fresh_path(spark, "t"), V, END_ID, file_ids=1000)
    got = read_boundaries(spark, path).orderBy("start").collect()
    rows = sorted((7 if i % 2 == 0 else i, "same text" if i % 2 == 0 else f"text {i}") for i in range(4000))
    assert sorted(tuple(r)[0::2] for r in got) == sorted(e[0::2] for e in expected(rows))
    assert [r.doc_id for r in got] == [i for i, _ in rows] and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_words_are_joined_whatever_they_hold_inside():
    """Words between surely solid signs are encoded side by side: one call for all of them."""
    library = ByteLevel(V)
    words = [f"{gap}{w}".encode() for w in ("café", "naïve", "日本語", "a\tb", "x  y", "don't", "é", "plain", "<|endoftext|>") for gap in " \n"] * 30
    calls, encode = [], library._encode
    library._encode = lambda texts: calls.append(len(texts)) or encode(texts)
    ids, sizes = library.encode([b"first", *words, b" ", b"last "])
    assert sum(calls) == 4  # the words between as one text, three by themselves
    single = [Tokenizer.from_str(V).encode(w.decode(), add_special_tokens=False).ids for w in (b"first", *words, b" ", b"last ")]
    assert sizes.tolist() == [len(x) for x in single] and ids.tolist() == [i for x in single for i in x]


@pytest.mark.parametrize("words", [[b"%06d" % i for i in range(500_000)], [bytes([65 + i]) * (1 << 20) for i in range(20)]])
def test_what_a_worker_remembers_is_bounded_in_words_and_bytes(words):
    """Half a million short words fill the table, and so do twenty of a megabyte."""
    learned, kept = [], []
    table = WordTable(learned.extend, lambda codes: kept.append(codes.tolist()))

    def codes(some):
        data = np.frombuffer(b"".join(some), np.uint8)
        found, places = table.codes(as_words(data, np.cumsum([0, *map(len, some[:-1])])))
        return found[places].tolist()

    assert codes(words[1:6]) == [0, 1, 2, 3, 4] and not table.reset_if_full()
    assert codes(words) == [5, 0, 1, 2, 3, 4, *range(6, len(words))] and len(learned) == len(words)
    assert table.full() and table.reset_if_full() and not table.full()
    assert kept == [[0, 1, 2, 3, 4]]  # those asked for more than once; of the others nothing is left
    assert codes(words[7:2:-1]) == [5, 6, 4, 3, 2] and learned[len(words):] == [words[7], words[6]]


def test_forgetting_changes_no_ids():
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["one", "two", "three", "日本", f"w{rng.randrange(400)}"]) for _ in range(50)) for _ in range(60)]
    encoder, want = _Encoder(V), expected(enumerate(texts))
    encoder.table.most, resets = 60, 0
    for text, (_, _, n, crc) in zip(texts, want):
        resets += encoder.table.full()
        data = np.frombuffer(text.encode(), np.uint8)
        ids, stops = encoder.encode(data, np.array([0, len(data)]))
        assert stops.tolist() == [n - 1] and zlib.crc32(np.append(ids, END_ID).astype("<u4").tobytes()) == crc
    assert resets > 3
