import math

import numpy as np
import pytest

from labflow.llm import capfilters, nearest, queries_vectors
from labflow.llm.components import components
from labflow.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int"
BAD = [(901, None, 0), (902, [0.0] * 8, 0), (903, [math.nan] * 8, 0), (904, [1.0, None] * 4, 0), (905, [math.inf] * 8, 0)]


def made(n, d, seed, copies=0):
    """Random vectors, near copies of the first ones, and exact copies of one."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d)).astype("f4")
    near = x[: n // 4] + 0.1 * rng.standard_normal((n // 4, d)).astype("f4")
    x = np.concatenate([x, near, np.repeat(x[:1], copies, 0)])
    return [(i, [float(c) for c in v], int(i % (n // 4)) % 3 if n > 3 else 0) for i, v in enumerate(x)]


def valid(rows):
    return [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1]) and any(r[1])]


def brute_nearest(rows, k, wanted):
    rows = valid(rows)
    x = np.array([r[1] for r in rows], "f4").astype("f8")
    ids = np.array([r[0] for r in rows])
    out = {}
    for i in np.flatnonzero([wanted(r[0]) for r in rows]):
        exact = nearest.distances(x, np.broadcast_to(x[i], x.shape))
        order = [j for j in np.lexsort((ids, exact)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(exact[j])) for j in order]
    return out


@pytest.mark.parametrize("n,d,k,block", [(600, 64, 10, 100), (300, 8, 5, 8192), (3, 3, 10, 8192)])
def test_nearest_by_brute_force(spark, n, d, k, block):
    rows = made(n, d, 1, copies=30) + (BAD if d == 8 else [])
    frame = spark.createDataFrame([(*r, 1.0) for r in rows], SCHEMA + ", SCORE double").repartition(3)
    got = nearest.search(frame, frame.where("vec_id % 20 = 0"), k, block=block).collect()
    expected = brute_nearest(rows, k, lambda i: i % 20 == 0)
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found.keys() == expected.keys()
    hits = sum(len(set(found[q]) & set(expected[q])) for q in expected)
    assert hits >= 0.98 * sum(map(len, expected.values()))
    assert all(len(found[q]) == len(expected[q]) for q in expected)


def test_copies_of_a_query_come_first_by_id(spark):
    rows = made(300, 16, 4, copies=40)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = nearest.search(frame, frame.where("vec_id = 0"), 10).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(375, 385)) and all(r.score == 0 for r in got)


def test_bounds_hold_for_nearly_all():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    turn = nearest.rotation(64, nearest.SEED)
    bits, norms, factors = nearest.encode(x, x.mean(0), turn)
    middle, low = nearest.estimate(bits, norms, factors, q, x.mean(0), turn)
    exact = ((q[:, None] - x[None]) ** 2).sum(2)
    assert (low <= exact).mean() > 0.995
    assert abs((middle - exact).mean()) < 0.5 and bits.shape == (2000, 8)


def brute_links(rows, threshold=0.93):
    rows = [r for r in valid(rows) if r[2] is not None]
    n, parent = {}, {r[0]: r[0] for r in rows}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a in rows:
        n[a[0]] = 0
        for b in rows:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], "f4").astype("f8"), np.array(b[1], "f4").astype("f8")
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    n[a[0]] += 1
                    low, high = sorted((root(a[0]), root(b[0])))
                    parent[high] = low
    return {r[0]: (n[r[0]], root(r[0])) for r in rows}


@pytest.mark.parametrize("d,block", [(64, 512), (64, 8), (8, 512)])
def test_links_by_brute_force(spark, d, block):
    rows = made(160, d, 2, copies=25) + (BAD if d == 8 else []) + [(950, [1.0] * d, None), (951, [1.0] * 5, 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", N_LINKS string").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in capfilters.near_duplicates(frame, block=block).collect()}
    expected = brute_links(rows)
    assert got == {r[0]: expected.get(r[0], (0, r[0])) for r in rows}


def test_a_large_group_of_near_copies_in_blocks(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    rows = [(i, [float(c) for c in centre + 0.05 * rng.standard_normal(32)], 0) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = capfilters.near_duplicates(frame, block=64).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)} and sum(r.kept for r in got) == 1


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    none.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries_vectors.op4_one_bit_neighbours(spark, str(tmp_path)).count() == 0
    assert queries_vectors.op6_cap_filter_duplicates(spark, str(tmp_path)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame, Scratch(spark, "test")).collect()}
    assert got == {i: root(i) for i in parent}
    assert components(frame.limit(0), Scratch(spark, "test")).count() == 0
