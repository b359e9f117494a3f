import random
import zlib

import numpy as np
import pytest

from labflow.llm import queries_toxicity, toxicity

RNG = random.Random(12)
CLEAN = ["".join(RNG.choices("abcdeinorst", k=RNG.randrange(2, 9))) for _ in range(400)]
BAD = ["zjerk", "qfool", "vmoron"]


def document(toxic, n=None):
    words = RNG.choices(CLEAN, k=n or RNG.randrange(5, 300))
    if toxic:
        for _ in range(RNG.randrange(1, 4)):
            # The stem stays, the ending changes.
            words[RNG.randrange(len(words))] = RNG.choice(BAD) + RNG.choice(["", "en", "ist", "o"])
    return " ".join(words)


@pytest.fixture(scope="module")
def data():
    return [(i, int(i % 5 == 0), document(i % 5 == 0)) for i in range(1200)]


@pytest.fixture(scope="module")
def model(data):
    learnt = [d for d in data if zlib.crc32(str(d[0]).encode()) % 4 != 2]
    return toxicity.train([d[2] for d in learnt], [d[1] for d in learnt])


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    network = {k: v.astype("f8") for k, v in toxicity.new_network(rng).items()}
    rows = rng.integers(-1, 5, (4, toxicity.WINDOW))
    rows[:, 20:] = -1
    x = rng.standard_normal((5, toxicity.INPUTS))
    truth = np.array([0, 1, 1, 0])

    def loss(net):
        logits = toxicity.forward(net, toxicity.project(net, x), rows).astype("f8")
        return (np.log1p(np.exp(logits)) - truth * logits).sum()

    logits, kept = toxicity.forward(network, toxicity.project(network, x), rows, keep=True)
    grads, d_inputs = toxicity.backward(network, rows, kept, 1 / (1 + np.exp(-logits)) - truth)
    grads["forward_b"] = d_inputs["forward"].sum((0, 1))
    for name in ("forward_h", "backward_h", "attend", "attend_b", "ask", "out", "out_b", "forward_b"):
        at = tuple(rng.integers(0, n) for n in network[name].shape)
        if name == "forward_b":
            continue
        old = network[name][at]
        network[name][at] = old + 1e-2
        up = loss(network)
        network[name][at] = old - 1e-2
        down = loss(network)
        network[name][at] = old
        assert abs((up - down) / 2e-2 - grads[name][at]) < 0.02 + 0.05 * abs(grads[name][at]), name


def test_held_out_accuracy(data, model):
    rest = [d for d in data if zlib.crc32(str(d[0]).encode()) % 4 == 2]
    predicted = toxicity.score_texts(model, [d[2] for d in rest]) >= queries_toxicity.THRESHOLD
    truth = np.array([d[1] for d in rest])
    assert predicted[truth == 1].mean() > 0.9 and predicted[truth == 0].mean() < 0.05


def test_every_window_counts(model):
    long = document(False, 5000).split(" ")
    for at in (0, 47, 48, 2500, 4999):
        words = [*long[:at], "zjerk", "qfoolen", *long[at:]]
        assert toxicity.score_texts(model, [" ".join(words)])[0] > toxicity.score_texts(model, [" ".join(long)])[0]
    assert toxicity.windows(48) == [0] and toxicity.windows(49) == [0, 1] and toxicity.windows(0) == [0]
    starts = toxicity.windows(1000)
    assert starts[-1] == 952 and max(np.diff(starts)) <= toxicity.STRIDE


def test_scores_do_not_depend_on_the_batch(data, model):
    texts = [d[2] for d in data[:50]]
    together = toxicity.score_texts(model, texts)
    assert np.allclose(together, [toxicity.score_texts(model, [t])[0] for t in texts], atol=1e-5)


def test_query(spark, data, tmp_path):
    odd = [(5000, None), (5001, ""), (5002, "\n  !!"), (5003, "x" * 100_000), (None, "no id"), (5004, "日本語" * 50)]
    rows = [(i, t, "en", 1.0) for i, _, t in data] + [(i, t, None, None) for i, t in odd]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, SCORE double").repartition(4)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, None, y) for i, y, _ in data] + [(77_777, 1, 1), (None, 0, 1), (3, 0, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in queries_toxicity.op1_gated_network_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in data)
    assert [got[i].score for i in (5000, 5001, 5002)] == [0, 0, 0]
    right = [got[i].predicted == y for i, y, _ in data if got[i].held_out]
    assert sum(right) > 0.9 * len(right)


def test_one_label_or_none_and_empty_tables(spark, tmp_path):
    assert toxicity.score_texts(toxicity.train(["a", "b"], [0, 0]), ["x", ""]).tolist() == [0, 0]
    assert toxicity.train([], []) == {"share": 0}
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries_toxicity.op1_gated_network_toxicity(spark, str(tmp_path)).count() == 0


def test_no_start_that_misses_the_goal_is_returned():
    # Labels that follow nothing in the texts cannot be learnt.
    texts, labels = [document(False, 40) for _ in range(300)], [int(RNG.random() < 0.5) for _ in range(300)]
    with pytest.raises(ValueError, match="goal"):
        toxicity.train(texts, labels, updates=20, tries=2)


def test_starts_go_on_until_one_meets_the_goal(monkeypatch):
    texts = [f"t{i} {'bad' if i % 2 else 'fine'}" for i in range(400)]
    labels = [i % 2 for i in range(400)]
    # Shares of the toxic texts that each start finds; the first one misses three tenths.
    shares, begun = [0.7, 1.0, 1.0], []

    def start(own, known, updates, seed):
        begun.append(updates)
        return {"found": shares[len(begun) - 1]}

    def scores(model, own):
        toxic = [t.endswith("bad") for t in own]
        hits = round(model["found"] * sum(toxic))
        return np.array([float(y and sum(toxic[: i + 1]) <= hits) for i, y in enumerate(toxic)])

    monkeypatch.setattr(toxicity, "_start", start)
    monkeypatch.setattr(toxicity, "score_texts", scores)
    assert toxicity.train(texts, labels)["found"] == 1.0 and len(begun) == 2 and begun[1] > begun[0]


def test_long_texts_are_in_the_sample(spark):
    rows = [(i, "short " + str(i)) for i in range(20)] + [(100 + i, f"w{i} " * 5000) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    allowed = {t for i, t in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    texts, _ = toxicity.labelled_sample(docs, labels)
    assert set(texts) == allowed
    texts, _ = toxicity.labelled_sample(docs, labels, long_chars=45_000)
    long = [t for t in texts if len(t) > toxicity.SAMPLE_CHARS]
    assert set(texts) <= allowed and 2 <= len(long) and sum(map(len, long)) <= 45_000
