import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import ODD, SF
from textloom.llm.queries import VOCABULARY, op3_token_counts, vocabulary
from textloom.llm.token_counts import _pieces, count_tokens

V = vocabulary(public_tokenizers.path(VOCABULARY))
HARD = ["a\x1cb c\x1dd", "é ́x <|endoftext|>foo<|endoftext|> bar's", "\n\n \t a  b", "½ 12345 日本語 ok", "İI ΑΣ Σς", "don't  stop now"]


def expected(texts):
    t = Tokenizer.from_str(V)
    return [len(t.encode(x or "", add_special_tokens=False)) for x in texts]


def test_counts_are_the_library_s(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = op3_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == dict(zip(texts, expected(texts.values())))
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_odd_rows_and_hard_texts(spark, odd, none):
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in count_tokens(odd, V, slice_bytes=50_000).collect())
    assert got == sorted((i or 0, len((t or "").encode()), n) for (i, t), n in zip(ODD, expected(t for _, t in ODD)))
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id int, text string")
    for boundary in (True, False):
        got = {r.doc_id: r.n_tokens for r in count_tokens(df, V, space_is_boundary=boundary).collect()}
        assert got == dict(enumerate(expected(HARD)))
    assert count_tokens(none, V).count() == 0


def test_pieces_put_together_again():
    text = ("word " * 50 + "x" * 300 + "\nend of it").encode()
    for target in (1, 7, 100, 10_000):
        parts = _pieces(text, target)
        assert "".join(parts).encode() == text and all(p[-1] in " \n" for p in parts[:-1])
