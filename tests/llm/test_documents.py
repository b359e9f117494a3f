import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from labflow.llm import bagminhash, queries_documents, shingles

RNG = random.Random(4)
WORDS = ["w%d" % i for i in range(500)]


def prose(n):
    return " ".join(RNG.choices(WORDS, k=n))


def changed(text, share):
    words = text.split(" ")
    for i in RNG.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = RNG.choice(WORDS) + "x"
    return " ".join(words)


def bag(text):
    words = (text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def brute(rows, threshold=0.8):
    bags = {i: bag(t) for i, t in rows if i is not None}
    parent = {i: i for i in bags}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in bags if bags[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if root(i) != root(j) and similarity(bags[i], bags[j]) >= threshold:
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {i: root(i) for i in parent}


def corpus():
    base = [prose(n) for n in (4, 7, 30, 120, 400, 3000)]
    rows = [*base, None, "", "  \n ", None, "", base[3], base[3], "one", "one", "one two", " " + base[2]]
    for text in base[3:]:
        rows += [changed(text, s) for s in (0.005, 0.01, 0.02, 0.05)]
    hub = prose(200)
    rows += [hub, *[changed(hub, 0.02) for _ in range(60)], *[hub] * 40]
    rows += ["same word " * 300, "same word " * 290, "same word " * 100]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [1000, 7])
def test_classes_by_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(bagminhash, "BLOCK_DOCS", block)
    rows = corpus()
    frame = spark.createDataFrame([(*r, "x") for r in rows] + [(None, "no id", "x")], "doc_id long, text string, KEPT string")
    got = bagminhash.near_duplicates(frame.repartition(5)).collect()
    assert {r.doc_id: r.class_id for r in got} == {**brute(rows), None: None}
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_signatures_estimate_without_bias():
    rng = np.random.default_rng(8)
    for _ in range(3):
        keys = rng.integers(0, 2**63, 40).astype("u8")
        a, b = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
        a[:3] = (1000, 70, 3)
        expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        pair = [(np.sort(keys[w > 0]), w[w > 0][np.argsort(keys[w > 0])]) for w in (a, b)]
        x, y = bagminhash.signatures(pair, registers=20_000)
        assert abs((x == y).mean() - expected) < 4 * (expected * (1 - expected) / 20_000) ** 0.5 + 1e-9
        assert np.isfinite(x).all()
    # A signature does not depend on what else is in the batch.
    alone = bagminhash.signatures(pair[:1], registers=100)
    assert (alone[0] == bagminhash.signatures(pair[::-1], registers=100)[1]).all()


def test_bags_match_words():
    texts = ["a b c d e f g", "", " \t\n", "a", "é  b\r\nc d e f", "x" * 5000, "a b c d e f g", "b c d e f"]
    found = shingles.bags(pa.array(["skipped", *texts]).slice(1))
    assert [int(n.sum()) for _, n in found] == [sum(bag(t).values()) for t in texts]
    assert (found[0][0] == found[6][0]).all() and found[7][0][0] in found[0][0]
    assert len(np.unique(np.concatenate([b[0] for b in found]))) == len({s for t in texts for s in bag(t)})


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries_documents.op5_bag_minhash_duplicates(spark, str(tmp_path)).count() == 0
