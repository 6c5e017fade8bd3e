import hashlib
import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import ODD, SF
from tests.llm.test_token_files import SIGNS
from textloom.llm.alignment import Aligner, align, pair_counts, Tokenizers
from textloom.llm.queries import BYTE_VOCABULARY, PIECES, op13_alignment, piece_model, vocabulary
from textloom.llm.words import byte_alphabet

V, M = vocabulary(public_tokenizers.path(BYTE_VOCABULARY)), piece_model(public_tokenizers.path(PIECES))


def brute(texts):
    """Rows by the libraries on whole texts, byte by byte."""
    tok, sp = Tokenizer.from_str(V), sentencepiece.SentencePieceProcessor(model_proto=M)
    tok.encode_special_tokens = True
    signs, names = byte_alphabet(), {i: t for t, i in tok.get_vocab().items()}

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    aligned = []
    for text in texts:
        a = tok.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ba, bb = [bytes(signs[c] for c in names[i]) for i in a], [piece(i) for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(ba) != whole or b"".join(bb) != whole:
            aligned.append(None)
            continue
        owner_a = [k for k, x in enumerate(ba) for _ in x]
        owner_b = [k for k, x in enumerate(bb) for _ in x]
        links = sorted(set(zip(owner_a, owner_b)))
        groups, ga, gb = [], [], []
        for at in range(len(whole)):
            if not ga or ga[-1] != owner_a[at]:
                ga.append(owner_a[at])
            if not gb or gb[-1] != owner_b[at]:
                gb.append(owner_b[at])
            if at + 1 == len(whole) or owner_a[at + 1] != owner_a[at] and owner_b[at + 1] != owner_b[at]:
                groups.append(",".join(str(a[k]) for k in ga) + "|" + ",".join(str(b[k]) for k in gb))
                ga, gb = [], []
        aligned.append((a, b, ";".join(groups), len(groups), [(a[i], b[j]) for i, j in links]))
    counts = Counter(p for x in aligned if x for p in x[4])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for x in aligned:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, text, n, links = x
            out.append((len(a), len(b), n, len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links), text))
    return out, counts


def hashed(row):
    return (*row[:6], hashlib.sha256(row[6].encode()).hexdigest() if row[6] else "")


def test_query_is_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, _ = brute(texts.values())
    got = {r.doc_id: tuple(r)[1:] for r in op13_alignment(spark, SF).collect()}
    assert got == dict(zip(texts, map(hashed, want)))


def test_any_signs_shipped_and_joined(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices([*SIGNS, "▁", "</s>", "<unk>", "\r"], k=rng.randrange(25))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(6)
    want, counts = brute(texts)
    assert any(w[6] == "" for w, t in zip(want, texts) if t) and any(w[6] for w in want)
    for most in (1 << 20, 0):
        got = {r.doc_id: tuple(r)[1:] for r in align(df, V, M, max_pairs=most, slice_bytes=500).collect()}
        assert got == dict(enumerate(want))
    found = {(r.a, r.b): r.n for r in pair_counts(df, Tokenizers(spark, V, M)).collect()}
    assert found == counts


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_odd_rows(spark, odd, none, most):
    want, _ = brute([t for _, t in ODD])
    got = align(odd, V, M, max_pairs=most, slice_bytes=20_000).collect()
    assert sorted((r.doc_id or 0, *tuple(r)[1:]) for r in got) == sorted((i or 0, *w) for (i, _), w in zip(ODD, want))
    assert align(none, V, M, max_pairs=most).count() == 0


def test_forgetting_words_and_whole_texts_change_nothing():
    texts = pa.array(["one two\nthree, four", "five\nsix 日本 end", "", "two two three"], pa.large_string())

    def rows(aligner):
        codes, places, starts, good = aligner.words(texts)
        aligner.write_groups()
        return [";".join(aligner.texts[codes[k]] for k in places[i:j]) if g else "" for i, j, g in zip(starts, starts[1:], good)]

    aligner = Aligner(V, M)
    want = rows(aligner)
    assert want == [w[6] for w in brute(texts.to_pylist())[0]]
    aligner.table.most = 1
    assert aligner.table.reset_if_full() and rows(aligner) == want
    aligner.whole = True
    assert rows(aligner) == want


def test_words_that_stay_keep_their_tokens_and_groups():
    """A table that starts anew over and over keeps the usual words, under new codes."""
    rng = random.Random(3)
    lines = [" ".join(rng.choice(["one", "two,", "three", "日本", f"w{rng.randrange(99)}"]) for _ in range(20)) for _ in range(40)]
    aligner, want, stayed = Aligner(V, M), brute(lines)[0], 0
    aligner.table.most = 40
    for line, known in zip(lines, want):
        if aligner.table.reset_if_full():
            stayed += len(aligner.table.known)
        codes, places, starts, good = aligner.words(pa.array([line], pa.large_string()))
        aligner.write_groups()
        assert good.all() and ";".join(aligner.texts[codes[k]] for k in places) == known[6]
        assert aligner.sizes(codes)[places].sum(axis=0).tolist() == list(known[:4])
    assert stayed > 20


def test_identity_map():
    aligner = Aligner(V, M)
    known = [(a, int(b)) for a, b in enumerate(aligner.identity) if b >= 0]
    assert len(known) > 10_000 and all(aligner.a.bytes_of[a] == aligner.b.bytes_of[b] for a, b in known)
