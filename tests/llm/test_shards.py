import zlib
from collections import defaultdict

import pytest

from tests.llm.conftest import ODD, SF, python_free
from textloom.llm import shards
from textloom.llm.queries import op1_sharding


def size(t):
    return len((t or "").encode()) + 1


def test_equal_bytes_gapless_slots(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    df = op1_sharding(spark, SF)
    assert python_free(df)
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    held, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert r.size == size(texts[r.doc_id]) and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    most = max(map(size, texts.values()))
    assert all(abs(b - sum(held.values()) / 16) <= most for b in held.values())


@pytest.mark.parametrize("count", [1, 3, 16])
def test_odd_rows(odd, count):
    rows = shards.assign_shards(odd, count).collect()
    assert sorted((r.doc_id or 0, r.size) for r in rows) == sorted((i or 0, size(t)) for i, t in ODD)
    for s in range(count):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))


def test_whole_rows_are_placed_alike(odd, docs):
    out = shards.shard_documents(odd, 3)
    assert out.columns == [c for c in odd.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    key = lambda r: (r.doc_id or 0, r.shard, r.slot)
    assert sorted(map(key, out.collect())) == sorted(map(key, shards.assign_shards(odd, 3).collect()))
    assert sorted(map(key, shards.shard_documents(docs).collect())) == sorted(map(key, shards.assign_shards(docs).collect()))


def test_a_hot_key_is_spread(spark):
    rows = [(i, "copy " * 40) for i in range(2000)] + [(9000 + i, f"text {i} " * 9) for i in range(1000)] + [(1, "row")] * 500
    placed = shards.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8, ranges=2).collect()
    held = defaultdict(int)
    for r in placed:
        held[r.shard] += r.size
    assert len(placed) == len(rows) and max(held.values()) - min(held.values()) < 3 * 201


def test_empty(none):
    assert shards.assign_shards(none).count() == 0 and shards.shard_documents(none).count() == 0


def test_overfull_ranges_are_cut(spark):
    records = spark.createDataFrame([(k, 100, 0, 1, k) for k in range(400)], "id long, size long, crc long, copies long, key long")
    cuts, found = shards._splitters(records, 4, 4)
    assert sum(r["rows"] for r in found) == 400 and max(r["bytes"] for r in found) <= 2 * 40_000 / 16
