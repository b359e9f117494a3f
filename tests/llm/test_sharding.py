import random

import pytest

from labflow.llm import queries_sharding, sharding


def brute(rows, shards):
    """(doc_id, size) in order -> {doc_id: (shard, slot)}."""
    total, end, found, slots = sum(s for _, s in rows), 0, {}, {}
    for d, s in rows:
        end += s
        k = min(shards - 1, (2 * end - s) * shards // (2 * total))
        found[d] = (k, slots.get(k, 0))
        slots[k] = slots.get(k, 0) + 1
    return found


def test_contiguous_and_balanced(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([1, 5, 20, 100])) for i in range(3000)]
    shuffled = rng.sample(rows, len(rows))
    frame = spark.createDataFrame([(d, s, "x") for d, s in shuffled], "doc_id long, size long, SLOT string").repartition(5)
    got = sharding.shard(frame, "doc_id", "size", 16).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in got} == brute(rows, 16)
    sizes = [sum(r["size"] for r in got if r.shard == k) for k in range(16)]
    assert max(sizes) - min(sizes) <= 2 * 100


def test_ties_nulls_and_repeated_rows(spark):
    frame = spark.createDataFrame([(None, 2)] * 40 + [(1, 2)] * 40 + [(2, 2)] * 80, "doc_id long, size long")
    got = sharding.shard(frame, "doc_id", "size", 4).collect()
    assert sorted((r.shard, r.slot) for r in got) == [(k, i) for k in range(4) for i in range(40)]
    assert {r.doc_id for r in got if r.shard == 0} == {None}


def test_empty_and_fewer_rows_than_shards(spark):
    frame = spark.createDataFrame([(1, 5), (2, 5)], "doc_id long, size long")
    assert sharding.shard(frame.limit(0), "doc_id", "size").count() == 0
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shard(frame, "doc_id", "size", 16).collect()}
    assert got == {1: (4, 0), 2: (12, 0)}


@pytest.mark.parametrize("texts", [[None, "", "é", "a" * 200_000, "b", "b"]])
def test_query(spark, tmp_path, texts):
    import zlib

    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries_sharding.op8_byte_shards(spark, str(tmp_path)).collect()}
    expected = brute([(i, len((t or "").encode()) + 1) for i, t in enumerate(texts)], 16)
    assert {i: (r.shard, r.slot) for i, r in got.items()} == expected
    assert all(got[i].text_crc32 == zlib.crc32((t or "").encode()) for i, t in enumerate(texts))
    assert all(got[i].size == len((t or "").encode()) + 1 for i, t in enumerate(texts))
