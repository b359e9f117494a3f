import random
import re

from pyspark.sql import functions as F

from labflow.llm import spans


def test_running_values(spark):
    rows = [(i, [random.Random(i).randrange(-50, 50) for _ in range(n)]) for i, n in enumerate([0, 1, 255, 256, 257, 5000])]
    frame = spark.createDataFrame(rows, "id long, v array<long>")
    got = frame.select("id", spans.running(F.col("v")).alias("s"), spans.running(F.col("v"), F.greatest, -100).alias("m")).collect()
    for r, (_, v) in zip(sorted(got), rows):
        assert r.s == [sum(v[: i + 1]) for i in range(len(v))]
        assert r.m == [max(v[: i + 1]) for i in range(len(v))]


def cover(text, found):
    return [any(a <= i < b for a, b in found) for i in range(len(text))]


def test_places_gaps_and_cuts(spark):
    rng = random.Random(2)
    texts = [None, "", "no", "ab12", "é😀12 \n 3"] + ["".join(rng.choices("ab1 é😀\n", k=rng.randrange(60))) for _ in range(200)]
    texts += ["1a " * 3000]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, t string").repartition(3)
    t = F.coalesce("t", F.lit(""))
    found = frame.select("id", t.alias("t"), spans.places(t, "[0-9]+").alias("n"), spans.places(t, "[a-z]+[0-9]?").alias("w"))
    got = found.select(
        "*",
        spans.outside(F.col("n"), F.col("w")).alias("alone"),
        spans.cut(F.col("w"), F.col("n")).alias("pieces"),
        spans.replaced(F.col("t"), F.concat(F.col("w"), F.col("n")), "#").alias("r"),
    ).collect()
    assert len(got) == len(texts)
    for r in got:
        own = texts[r.id] or ""
        n, w = [(m.start(), m.end()) for m in re.finditer("[0-9]+", own)], [(m.start(), m.end()) for m in re.finditer("[a-z]+[0-9]?", own)]
        assert [(x.start, x.end) for x in r.n] == n and [(x.start, x.end) for x in r.w] == w
        if r.n:
            edges = [0] + [e for _, e in n]
            assert [x.left for x in r.n] == [own[a:b] for a, (b, _) in zip(edges, n)]
            assert [x.right for x in r.n] == [own[e:s] for (_, e), s in zip(n, [s for s, _ in n[1:]] + [len(own)])]
        assert [(x.start, x.end) for x in r.alone] == [x for x in n if not any(a < x[1] and x[0] < b for a, b in w)]
        numbers = cover(own, n)
        pieces = []
        for a, b in w:
            for m in re.finditer("x+", "".join("." if numbers[i] else "x" for i in range(a, b))):
                pieces.append((a + m.start(), a + m.end(), own[a + m.start() : a + m.end()]))
        assert [tuple(x) for x in r.pieces] == pieces
        shown, at = "", 0
        for a, b in sorted(n + w):
            shown += own[at:a] + "#" if a >= at else ""
            at = max(at, b)
        assert r.r == shown + own[at:]
