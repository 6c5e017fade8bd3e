import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import build_vocabulary, count_tokens, encode, pack, pack_dropped, token_offsets, tokens

TEXTS = [(3, "b a b"), (1, "a c"), (2, ""), (5, None), (4, "d b b a")]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id int, text string")


def test_vocabulary_by_frequency_then_word(texts):
    got = {r.word: r.id for r in build_vocabulary(texts, first_id=10).collect()}
    assert got == {"b": 10, "a": 11, "c": 12, "d": 13}


@pytest.mark.parametrize("in_place", [True, False])
def test_encode(texts, in_place):
    vocabulary = build_vocabulary(texts, first_id=2).where("word <> 'd'")
    got = {r.doc_id: r.input_ids for r in encode(texts, vocabulary, bos_id=1, unk_id=0, in_place=in_place).collect()}
    assert got == {1: [1, 3, 4], 2: [1], 3: [1, 2, 3, 2], 4: [1, 0, 2, 2, 3], 5: None}
    got = {r.doc_id: r.input_ids for r in encode(texts, vocabulary, in_place=in_place).collect()}
    assert got == {1: [3, 4], 2: [], 3: [2, 3, 2], 4: [2, 2, 3], 5: None}


@pytest.mark.parametrize("in_place", [True, False])
def test_encode_by_text_alone(spark, in_place):
    df = spark.createDataFrame([(1, "a b"), (1, "a c"), (None, "a b"), (2, None)], "doc_id int, text string")
    vocabulary = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "word string, id int")
    got = sorted((r.doc_id or 0, r.input_ids or []) for r in encode(df, vocabulary, in_place=in_place).collect())
    assert got == [(0, [0, 1]), (1, [0, 1]), (1, [0, 2]), (2, [])]
    none = vocabulary.where("id > 9")
    got = sorted((r.doc_id or 0, r.input_ids or []) for r in encode(df, none, unk_id=9, in_place=in_place).collect())
    assert got == [(0, [9, 9]), (1, [9, 9]), (1, [9, 9]), (2, [])]


def test_packing_needs_unique_ids(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [3, 4])], "doc_id int, input_ids array<int>")
    for run in (pack, pack_dropped):
        with pytest.raises(ValueError):
            run(df, 2).collect()


def test_built_in_counters(spark):
    df = spark.createDataFrame([("một, 12 hai!",), ("",), (None,)], "text string")
    assert [r.n_tokens for r in count_tokens(df).collect()] == [3, 0, None]
    assert [r.n_tokens for r in count_tokens(df, "regex").collect()] == [5, 0, None]
    with pytest.raises(ValueError):
        count_tokens(df, "no-such-model")


def test_a_loader_of_ones_own(spark):
    df = spark.createDataFrame([("ab cd",), ("é",), (None,)], "text string")

    def load():
        return lambda batch: [len(t.encode()) for t in batch]

    assert [r.n_tokens for r in count_tokens(df, load).collect()] == [5, 2, None]


def packed(lists, block, batch):
    out = {}
    keys = sorted(lists)
    for b in range(0, len(keys), batch):
        flat = [t for k in keys[b:b + batch] for t in lists[k]]
        for i in range(len(flat) // block):
            out[b // batch, i] = flat[i * block:(i + 1) * block]
    return out


LISTS = [
    {0: [1, 2], 1: [3]},                                   # batch below a block
    {0: [1, 2], 1: [3, 4]},                                # exactly a block
    {0: [1, 2, 3], 1: [4, 5]},                             # one more
    {0: list(range(23)), 1: [], 2: [50], 3: list(range(60, 69)), 4: [1], 5: [2, 3, 4, 5], 9: list(range(17))},
]


@pytest.mark.parametrize("lists", LISTS)
@pytest.mark.parametrize("batch", [1, 2, 3, 100])
def test_pack_equals_plain_concatenation(spark, lists, batch):
    df = spark.createDataFrame([(k, v) for k, v in lists.items()], "doc_id int, input_ids array<int>").repartition(3)
    rows = pack(df, 4, batch).collect()
    assert {(r.batch, r.block): r.input_ids for r in rows} == packed(lists, 4, batch)
    assert all(r.labels == r.input_ids and r.attention_mask == [1] * 4 for r in rows)
    lost = pack_dropped(df, 4, batch).collect()
    assert sum(r.tokens for r in lost) == sum(map(len, lists.values()))
    assert sum(r.blocks for r in lost) == len(rows) and all(r.dropped == r.tokens - 4 * r.blocks for r in lost)


def test_offsets(spark):
    df = spark.createDataFrame([(7, [1, 2]), (8, None), (9, [3])], "doc_id int, input_ids array<int>")
    rows = {r.doc_id: (r.row_idx, r.batch, r.start, r.n, r.batch_total) for r in token_offsets(df, 2).collect()}
    assert rows == {7: (0, 0, 0, 2, 2), 8: (1, 0, 2, 0, 2), 9: (2, 1, 0, 1, 1)}


def test_pack_keeps_every_token_it_does_not_report(spark, docs):
    ids = docs.select("doc_id", F.transform(F.split("text", " "), lambda w: F.char_length(w)).alias("input_ids"))
    blocks = pack(ids, 64, 50).count()
    lost = pack_dropped(ids, 64, 50).agg(F.sum("tokens"), F.sum("blocks"), F.sum("dropped")).first()
    assert blocks == lost[1] and lost[0] == 64 * blocks + lost[2]


def packed_globally(lists, block):
    flat = [t for k in sorted(lists) for t in lists[k] or []]
    return {(0, i): flat[i * block:(i + 1) * block] for i in range(len(flat) // block)}


@pytest.mark.parametrize("lists", LISTS)
@pytest.mark.parametrize("block", [4, 7])
def test_global_packing_has_one_remainder(spark, lists, block):
    df = spark.createDataFrame([(k, v) for k, v in lists.items()], "doc_id int, input_ids array<int>").repartition(3)
    rows = pack(df, block, mode="global").collect()
    assert {(r.batch, r.block): r.input_ids for r in rows} == packed_globally(lists, block)
    assert all(r.labels == r.input_ids and r.attention_mask == [1] * block for r in rows)
    n = sum(map(len, lists.values()))
    assert [tuple(r) for r in pack_dropped(df, block, mode="global").collect()] == [(0, n, n // block, n % block)]


def test_global_packing_over_many_slices(spark):
    """Documents without tokens, null ones, one that holds a third of all tokens and fills many blocks;
    blocks run over the borders of slices."""
    rng = random.Random(6)
    lists = {k * 3 - 500: [rng.randrange(1000) for _ in range(rng.choice([0, 0, 1, 2, 9, 40]))] for k in range(400)}
    lists[-2] = list(range(2500))
    lists[1] = None
    df = spark.createDataFrame([(k, v) for k, v in lists.items()], "doc_id int, input_ids array<int>").repartition(9)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small slices stay apart
    try:
        got = {(r.batch, r.block): r.input_ids for r in pack(df, 64, mode="global").collect()}
        at = {r.doc_id: (r.row_idx, r.start, r.batch_total) for r in token_offsets(df, mode="global").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert got == packed_globally(lists, 64)
    total, start = sum(len(v or []) for v in lists.values()), 0
    for i, k in enumerate(sorted(lists)):
        assert at[k] == (i, start, total)
        start += len(lists[k] or [])


def test_stretches_of_any_length(spark, monkeypatch):
    """Rows that begin, end and fill stretches; ids that are strings."""
    rng = random.Random(9)
    for stretch, block in ((8, 4), (64, 64), (30, 7), (1000, 16)):
        monkeypatch.setattr(tokens, "STRETCH_TOKENS", stretch)
        lists = {f"é{k:04d}": [rng.randrange(99) for _ in range(rng.choice([0, 1, 3, stretch, 2 * stretch, 200]))] for k in range(120)}
        df = spark.createDataFrame(list(lists.items()), "doc_id string, input_ids array<int>").repartition(4)
        got = {(r.batch, r.block): r.input_ids for r in pack(df, block, mode="global").collect()}
        assert got == packed_globally(lists, block)


def test_global_packing_plans_no_single_task_and_one_shuffle_of_tokens(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), F.array_repeat(F.lit(7), 5).alias("input_ids"))
    plan = pack(df, 8, mode="global")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(stretch" in plan and "Join" not in plan
    for out in (pack(df, 8, mode="global"), token_offsets(df, mode="global")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "Window" in plan
    with pytest.raises(ValueError, match="mode"):
        pack(df, 8, mode="all")
    none = df.limit(0)
    assert pack(none, 8, mode="global").count() == 0 and token_offsets(none, mode="global").count() == 0


def test_running_total(spark):
    from textloom.plans import with_running_total

    rng = random.Random(7)
    rows = [(k, rng.randrange(-5, 10**12)) for k in rng.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(8)
    got = {r.k: (r.row_idx, r.before) for r in with_running_total(df, "v", F.col("k").desc()).collect()}
    total = 0
    for i, (k, v) in enumerate(sorted(rows, reverse=True)):
        assert got[k] == (i, total)
        total += v
    with pytest.raises(ValueError):
        with_running_total(df.withColumn("before", F.lit(1)), "v", "k")


def test_words_joined_once_a_chunk(spark, monkeypatch):
    """Rows of many chunks get what the shipped table gives, and a chunk asks for a word once."""
    from textloom.plans import lexicon

    rows = [(i % 40 if i % 9 else None, None if i % 7 == 0 else " ".join(f"w{(i * k) % 23}" for k in range(i % 60)) + " the" * 50) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    vocabulary = build_vocabulary(df, first_id=2).where("word <> 'w5'")
    stored = []
    in_chunks = lexicon._in_chunks
    monkeypatch.setattr(lexicon, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(lexicon, "SLICE_BYTES", 1000)
    monkeypatch.setattr(lexicon, "_in_chunks", lambda *a: stored.append(in_chunks(*a)) or stored[-1])
    for unk in (None, 0):
        got, want = (
            sorted(((r.doc_id, r.input_ids) for r in encode(df, vocabulary, 1, unk, in_place=p).collect()), key=repr) for p in (False, True)
        )
        assert got == want and len(got) == 300 and len({str(x) for x in got}) > 100
    asked = stored[0].where("__words is not null").select("__chunk", F.explode("__words").alias("w"))
    assert asked.select("__chunk").distinct().count() > 6
    assert asked.count() == asked.distinct().count() < df.select(F.explode(F.split("text", " "))).count() / 5
    assert encode(df.limit(0), vocabulary, in_place=False).count() == 0
