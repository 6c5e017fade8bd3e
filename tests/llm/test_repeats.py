import random
import re
from collections import defaultdict

import pytest

from tests.llm.conftest import LONG, SF
from textloom.llm.queries import op8_repeated_spans
from textloom.llm.repeats import repeated_spans, without_spans

LEAST, CERTAIN = 25, 48  # words of a span, and of a passage that must hold one


def words_of(t):
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]


def check(rows, found):
    """By words alone.  What is removed lies in runs of at least 25 words that stand elsewhere
    first; of every run of 48 words that stands elsewhere first, something is removed."""
    texts = {i: words_of(t.encode()) for i, t in sorted(rows)}
    firsts = {}
    for i, words in texts.items():
        for k in range(len(words) - LEAST + 1):
            firsts.setdefault(tuple(w for _, _, w in words[k:k + LEAST]), (i, k))
    gone = defaultdict(set)
    for i, lo, hi in found:
        inside = [k for k, (a, b, _) in enumerate(texts[i]) if a >= lo and b <= hi]
        assert inside and texts[i][inside[0]][0] == lo and texts[i][inside[-1]][1] == hi
        gone[i] |= set(inside)
    for i, words in texts.items():
        old = [firsts[tuple(w for _, _, w in words[k:k + LEAST])] != (i, k) for k in range(len(words) - LEAST + 1)]
        covered = {k + j for k, o in enumerate(old) if o for j in range(LEAST)}
        assert gone[i] <= covered
    long = {}
    for i, words in texts.items():
        for k in range(len(words) - CERTAIN + 1):
            first = long.setdefault(tuple(w for _, _, w in words[k:k + CERTAIN]), (i, k))
            if first != (i, k):
                assert gone[i] & set(range(k, k + CERTAIN)), (i, k, first)
    return gone


def stretches(df):
    return [(r.doc_id, r.start, r.end) for r in df.collect()]


def test_given_documents(spark, docs):
    found = op8_repeated_spans(spark, SF)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = check(rows, stretches(found))
    assert sum(map(len, gone.values())) > 1000
    cuts = defaultdict(set)
    for i, lo, hi in stretches(found):
        cuts[i] |= set(range(lo, hi))
    kept = {r.doc_id: r.text for r in without_spans(docs, found).collect()}
    for i, text in rows:
        assert kept[i].encode() == bytes(c for k, c in enumerate(text.encode()) if k not in cuts[i])


def test_a_passage_stays_where_it_stands_first(spark):
    passage = " ".join(f"Sentence {k} of it has seven words." for k in range(9))
    rows = [(3, f"Own start here. {passage} Own end."), (1, f"{passage}"), (2, f"Else.\n{passage}\nMore."), (4, "Nothing of that kind.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_spans(df).collect()
    assert {(r.doc_id, r.first_id) for r in found} == {(2, 1), (3, 1)}
    texts = {r.doc_id: r.text for r in without_spans(df, repeated_spans(df)).collect()}
    assert texts == {1: passage, 2: "Else.\n\nMore.", 3: "Own start here.  Own end.", 4: "Nothing of that kind."}


def filler(rng, n, mark=0.0):
    return [f"own{rng.randrange(10**7)}" + ("." if rng.random() < mark else "") for _ in range(n)]


@pytest.mark.parametrize("mark", [0.0, 0.04, 0.15])
def test_no_passage_is_lost_whole(spark, mark):
    """A thousand passages of 51 to 80 words, without marks or with some, each between other words of
    two documents."""
    rng = random.Random(5)
    rows = []
    for k in range(1000):
        passage = [f"pass{k}w{rng.randrange(10**6)}" + ("." if rng.random() < mark else "") for _ in range(51 + k % 30)]
        for copy in range(2):
            rows.append((2 * k + copy, " ".join([*filler(rng, rng.randrange(40), mark), *passage, *filler(rng, rng.randrange(40), mark)])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = repeated_spans(df)
    gone = check(rows, stretches(found))
    assert {i for i in gone if gone[i]} == {2 * k + 1 for k in range(1000)}
    assert {r.first_id for r in found.collect()} == {2 * k for k in range(1000)}
    assert sum(len(gone[2 * k + 1]) for k in range(1000)) > 0.7 * sum(51 + k % 30 for k in range(1000))


@pytest.mark.parametrize("letters, marks", [
    ("天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽雲騰致雨露結為霜", "，。"),
    ("あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろわをん日本語文章", "、。"),
    ("กขคงจฉชซญดตถทธนบปผฝพฟภมยรลวศษสหอฮ", ""),
])
def test_passages_in_scripts_without_spaces(spark, letters, marks):
    rng = random.Random(6)

    def text(n):
        return "".join(rng.choice(marks) if marks and rng.random() < 0.06 else rng.choice(letters) for _ in range(n))

    rows = []
    for k in range(100):
        passage = text(120 + k)
        rows += [(2 * k, text(60) + passage + text(90)), (2 * k + 1, "Intro " + text(80) + passage + text(70) + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = repeated_spans(df).collect()
    assert {(r.doc_id, r.first_id) for r in found} == {(2 * k + 1, 2 * k) for k in range(100)}
    for r in found:
        piece = rows[r.doc_id][1].encode()[r.start:r.end].decode()
        assert len(piece) >= 50 and piece in rows[r.first_id][1]


def test_long_runs_without_letters_are_single_words(spark):
    link = "http://example.org/" + "a1" * 100
    rows = [(1, f"one {link} two"), (2, f"three {link} four"), (3, "x" * 5000)]
    assert repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def test_odd_rows(odd, none):
    found = repeated_spans(odd)
    assert {r.doc_id for r in found.collect()} == {7}  # its own sentences over and over
    out = without_spans(odd, found)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert len(out.where("doc_id = 7").first().text) < len(LONG) / 100
    assert repeated_spans(none).count() == 0 and without_spans(none, repeated_spans(none)).count() == 0
