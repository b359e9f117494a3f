import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from labflow.llm import pii, queries_pii

# The forms as they are stated, with Python's engine.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def kept(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(t):
    return [(k, m.start(), m.end()) for k, p in FORMS.items() for m in re.finditer(p, t, re.ASCII) if kept(k, m.group())]


def with_check(digits):
    return next(digits + str(d) for d in range(10) if luhn(digits + str(d)))


CARD, OTHER = with_check("453201511283036"), with_check("601100099013942")
ODD = [
    None,
    "",
    "nothing here",
    "a@b.c._x@y.z a@b.c@d.e .@-.- a..b@c..d x@y a@b.co.uk.",
    "é😀 mail tom.o%k+1@mail-1.example.com, ip 10.0.0.255 and 256.1.1.1, 1.2.3.4.5.6.7.8 0001.02.3.004",
    f"pay {CARD} or {CARD[:4]} {CARD[4:8]}-{CARD[8:12]} {CARD[12:]} not {CARD[:-1]}{(int(CARD[-1]) + 1) % 10}",
    f"two {CARD} {OTHER} side by side",
    "+1 (487) 555-7209, +49.30.1234567 +1( +1)2 +12345678 +123456789012345 +1234567890123456",
    f"+1 (017) 555-7713 {CARD}",
    "1" * 3000,
    "a" * 3000 + "@b.c " + "1." * 500 + "1 " + "1 " * 500 + "+1" + " " * 1000 + "(" * 1000,
    "x.y@z." * 500,
]


def texts():
    rng = random.Random(4)
    bits = ["a", ".", "@", "+", "1", "22", "255", "4532015112830366", " ", "-", "(", ")", "\n", "é", "😀", "555", "_", "%"]
    return ODD + ["".join(rng.choices(bits, k=rng.randrange(60))) for _ in range(500)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts())], "doc_id long, text string, SPANS string").repartition(3)


@pytest.fixture(scope="module")
def labelled(docs):
    return pii.labelled_candidates(docs).cache()


@pytest.fixture(scope="module")
def model(labelled):
    return pii.train(labelled)


def plain_score(c, model):
    total = model.bias[c.kind]
    for levels, values in model.trees[c.kind]:
        total += values[sum(1 << i for i, (feature, limit) in enumerate(levels) if c.f[feature] > limit)]
    return total


def test_query_by_brute_force(spark, docs, tmp_path, model):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries_pii.op12_boosted_private_spans(spark, str(tmp_path)).collect()}
    own = texts()
    assert len(got) == len(own)
    for i, t in enumerate(own):
        found = base_spans(t or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), i
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in found) for k in FORMS]
        assert r.spans == text or r.spans.startswith(text + ",") or not text
        assert all(x.split(":")[0] in pii.ADDED for x in r.spans[len(text) :].strip(",").split(",") if x)


def test_selection_by_brute_force(docs, model):
    """Candidates judged one by one in plain Python lead to the same spans."""
    rows = docs.where(F.length("text") < 1000).select(
        "doc_id", "text", pii.candidates(F.col("text")).alias("c"), pii.base_spans(F.col("text")).alias("base")
    )
    expected = {}
    for r in rows.collect():
        good = [
            c
            for c in r.c
            if model.thresholds[c.kind] is not None
            and plain_score(c, model) >= model.thresholds[c.kind]
            and not any(b.start < c.end and c.start < b.end for b in r.base)
        ]
        longest = {
            (c.kind, c.start, c.end)
            for c in good
            if not any(d.kind == c.kind and d.start <= c.start and c.end <= d.end and d.end - d.start > c.end - c.start for d in good)
        }
        expected[r.doc_id] = [(b.kind, b.start, b.end) for b in r.base] + [(pii.ADDED[k], a, b) for k, a, b in sorted(longest)]
        assert all(r.text[c.start : c.end] == c.value for c in r.c)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.scan(docs.where(F.length("text") < 1000), model).collect()}
    assert got == expected
    assert any(k in pii.ADDED for found in got.values() for k, *_ in found)


def test_windows_overlap(spark):
    frame = spark.createDataFrame([(f"tel 030 1234567 112.55.3.40 x{CARD} {OTHER}",)], "t string")
    found = frame.select(F.explode(pii.candidates(F.col("t"))).alias("c")).select("c.*").collect()
    values = {(pii.KINDS[r.kind], r.value) for r in found}
    assert {("phone", "030 1234567"), ("ip", "112.55.3.40"), ("card", CARD), ("card", OTHER)} <= values
    assert ("phone", "1234567 112.55") in values
    card = next(r for r in found if r.value == CARD)
    f = dict(zip(pii.FEATURES, card.f))
    assert (f["digits"], f["groups"], f["luhn"], f["after"], f["left"], f["right"]) == (16, 1, 1, 1, 2, 3)


def test_personal_data_that_patterns_miss(spark, model):
    texts = {
        f"two {CARD} {OTHER} side by side": {CARD, OTHER},
        f"call me +1 (017) 555-7713 {CARD} now": {"+1 (017) 555-7713", CARD},
        "write to anna.b2 (at) example (dot) com please": {"anna.b2 (at) example (dot) com"},
        "Tel. 0171-5551234, thanks": {"0171-5551234"},
        "look at home. Then 12 45 67 89 12 34 56 78 or 2024-01-15 at 10:30, version 1.22.345, 978-3-16-148410-1": set(),
        "12,000 people saw 3.5 of 7.25 km in 1999 - 2003": set(),
    }
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in pii.scan(frame, model).collect():
        found = {r.text[s.start : s.end] for s in r.spans}
        assert found == texts[r.text], r.text
    shown = pii.scan(frame, model).select("text", pii.redact(F.col("text"), F.col("spans")).alias("r")).collect()
    assert {r.r for r in shown} >= {"two [PRIVATE] [PRIVATE] side by side", "Tel. [PRIVATE], thanks"}


def test_held_out_rows(labelled, model):
    """On rows that neither fitted a tree nor set a threshold: other made texts."""
    other = pii.labelled_candidates(labelled.sparkSession.createDataFrame([], "doc_id long, text string"), sample_made=5000)
    rows = other.selectExpr("c", "label", "aside").collect()
    right = wrong = missed = 0
    for r in rows:
        t = model.thresholds[r.c.kind]
        chosen = t is not None and plain_score(r.c, model) >= t
        right, missed = right + (chosen and r.label), missed + (r.label and not chosen)
        # What only touches a personal value is never aside.
        wrong += chosen and not r.label and r.aside
    assert right / (right + missed) > 0.85 and wrong / right < 0.02


def test_no_rows_and_nothing_to_learn(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries_pii.op12_boosted_private_spans(spark, str(tmp_path)).count() == 0
    empty = spark.createDataFrame([], "c struct<kind:int,start:bigint,end:bigint,value:string,f:array<int>>, label int, aside boolean")
    nothing = pii.train(empty)
    assert nothing.thresholds == [None] * 4
    r = pii.scan(spark.createDataFrame([(1, "a@b.c 0171-5551234")], "doc_id long, text string"), nothing).first()
    assert [tuple(s) for s in r.spans] == [("email", 0, 5)]


def test_long_runs(spark, model):
    texts = {
        "1" * 300_000: 0,
        "a" * 300_000 + "@b.c": 1,
        "a@b" + ".c" * 50_000: 1,
        "x" * 300_000 + " +1" + " " * 100_000 + "(" * 100_000: 0,
        "7 " * 20_000: 0,
    }
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    for r in pii.scan(frame, model).collect():
        assert len([x for x in r.spans if x.kind in pii.KINDS]) == texts[r.text], r.text[:20]


def test_time_grows_with_the_text(spark, model):
    def seconds(n):
        line = f"a{CARD} b {OTHER} tel 0171-555{{}} x@y.de 10.0.0.1 "
        text = "".join(line.format(1000 + i % 9000) for i in range(n))
        frame = spark.createDataFrame([(text,)], "text string")
        started = time.perf_counter()
        r = pii.scan(frame, model).select(F.size("spans"), F.length(pii.redact(F.col("text"), F.col("spans")))).first()
        assert r[0] >= 4 * n
        return time.perf_counter() - started

    seconds(100)
    small, large = seconds(1_000), seconds(8_000)
    assert large < 8 * 2 * small + 5
