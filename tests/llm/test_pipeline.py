import random
import zlib

import pytest

import corpus_pipeline
from labflow.llm.queries import QUERIES, SQL

RNG = random.Random(21)
WORDS = ["".join(RNG.choices("abcdeinorst", k=RNG.randrange(2, 9))) for _ in range(500)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for i in range(400):
        toxic = int(i % 4 == 0)
        text = prose(60) + (" zjerk qfool " + prose(20) if toxic else "")
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, 1, toxic))
    near = prose(300)
    rows += [(1000, near, "en", "s", len(near)), (1001, near, "en", "s", len(near)), (1002, near + " more", "en", "s", 0)]
    rows += [(1003, "password=abcdefgh12 stays " + prose(30), None, None, None), (1004, None, None, None, None)]
    rows += [(1005, "", None, None, None), (None, "no id at all", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, folder)
        assert docs.columns == before.columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    toxic = {i for i in range(400) if i % 4 == 0}
    after = set(kept["toxicity"])
    assert len(toxic & after) <= 5 and len(set(range(400)) - toxic - after) <= 15
    assert {1000, 1003, 1004, 1005, None} <= after
    assert after - set(kept["minhash_near_dedup"]) == {1001, 1002}
    last = kept["secret_scan"]
    assert set(last) == set(kept["minhash_near_dedup"])
    assert last[1003].text.startswith("[SECRET] stays ") and last[1003].n_chars == len(last[1003].text)
    assert last[1004].text is None and last[1005].text == ""
    assert all(last[i].text == kept["toxicity"][i].text for i in last if i != 1003)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == set(last)


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(got.columns)
    assert got.where("doc_id = 1001").count() == 0 and got.where("doc_id = 1000").count() > 0


def test_sequences_hold_their_ids(spark):
    docs = spark.createDataFrame([(1, "The quick brown fox jumps."), (2, ""), (3, None)], "doc_id long, text string")
    got = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    assert {r.doc_id for r in got} == {1, 2, 3}
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)


def test_repeated_rows_leave_one(spark):
    text, other = prose(40), prose(40)
    rows = [(1, text, "en"), (1, text, "en"), (1, text, "de"), (2, other, "en"), (3, "", "a"), (3, "", "b")]
    rows += [(None, text, "en"), (None, text, "en"), (4, None, "en"), (4, None, "en"), (5, prose(40), "en"), (5, prose(50), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    got = stage(spark, docs, None)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert {i: ids.count(i) for i in set(ids)} == {1: 1, 2: 1, 3: 1, None: 2, 4: 2, 5: 2}


def test_no_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_packing_stage_takes_a_long_run_of_spaces(spark):
    from labflow.llm import stages

    docs = spark.createDataFrame([(1, "a" + " " * 1_200_000 + "b"), (2, "x")], "doc_id long, text string")
    packed = stages.pack_sequences(spark, docs, None).groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r[0]: r[1] == r[2] for r in packed} == {1: True, 2: True}
