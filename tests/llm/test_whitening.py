import math

import numpy as np
import pytest

from labflow.llm import queries_whitening, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, WHITENED string"
BAD = [
    (9001, None, 0, "x"),
    (9002, [], 0, "x"),
    (9003, [math.nan] * 24, 0, "x"),
    (9004, [1.0, None] * 12, 0, "x"),
    (9005, [math.inf] * 24, 0, "x"),
    (9006, [1.0] * 23, 0, "x"),
    (9007, [1e30] * 24, 0, "x"),
]


def made(n, d, seed=3, scale=0.2):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, d)) @ rng.standard_normal((d, d)) * scale).astype("f4")
    return [(i, [float(c) for c in v], 0, "x") for i, v in enumerate(x)]


def brute(rows):
    """{vec_id: (deviation, whitened)}, n, explained by plain arithmetic on all rows at once."""
    x = {r[0]: [math.floor(64 * c) + 1_000_000 for c in r[1]] for r in rows}
    fit = sorted({tuple(v) for v in x.values()})
    n, d = len(fit), len(fit[0])
    s = [sum(v[i] for v in fit) for i in range(d)]
    centred = np.array([[n * v[i] - s[i] for i in range(d)] for v in fit], object)
    products = centred.T @ centred
    v = np.array([[products[i, j] / n**3 for j in range(d)] for i in range(d)], "f8")
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:16], w[:, ::-1].T[:16]
    found = {}
    for k, own in x.items():
        c = [n * own[i] - s[i] for i in range(d)]
        found[k] = (sum(t * t for t in c), w @ np.array([t / n for t in c]) / np.sqrt(e))
    return found, n, e / np.trace(v)


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in queries_whitening.op13_polarised_whitening(spark, str(tmp_path)).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    return got


def test_query_by_brute_force(spark, tmp_path):
    rows = made(400, 24)
    # Copies count once in the fit and all have results.
    rows += [(1000 + i, rows[0][1], 0, "x") for i in range(200)] + [(5000, rows[1][1], 0, None)] * 2
    got = run(spark, tmp_path, rows + BAD)
    expected, n, explained = brute(rows)
    assert got.keys() == expected.keys()
    signs = None
    for k, (deviation, whitened) in expected.items():
        own = got[k]
        assert sorted(own) == list(range(1, 17))
        assert all(r.n == n and r.deviation == deviation and r.identity_error < 1e-9 for r in own.values())
        y = np.array([own[i].whitened for i in range(1, 17)])
        signs = np.sign(y * whitened) if signs is None else signs
        assert np.allclose(y, whitened * signs, rtol=1e-8, atol=1e-9)
    assert np.allclose([got[0][i].explained for i in range(1, 17)], explained, rtol=1e-10)


@pytest.mark.parametrize("d", [1, 3])
def test_few_dimensions(spark, tmp_path, d):
    got = run(spark, tmp_path, made(50, d, scale=5.0))
    assert all(sorted(own) == list(range(1, d + 1)) for own in got.values())
    assert math.isclose(sum(r.explained for r in got[0].values()), 1.0)


def test_components_without_variance(spark, tmp_path):
    rows = [(i, [float(i), 7.0, -2.0 * i], 0, "x") for i in range(20)]
    got = run(spark, tmp_path, rows)
    assert all(own[1].whitened is not None and own[2].whitened is None and own[3].whitened is None for own in got.values())
    assert all(own[2].explained == 0 and own[1].identity_error < 1e-9 for own in got.values())


def test_one_vector_and_none(spark, tmp_path):
    alone = run(spark, tmp_path / "a", [(1, [1.0, 2.0], 0, "x")] * 3)
    assert list(alone) == [1] and all(r.whitened is None and r.n == 1 and r.explained is None for r in alone[1].values())
    assert all(r.deviation == 0 and r.identity_error is None for r in alone[1].values())
    assert run(spark, tmp_path / "b", BAD[:1]) == {}


def test_large_values_stay_exact(spark, tmp_path):
    rows = [(i, [float((i * 7919) % 1000) * 2.0**40, float(i % 13), float(i)], 0, "x") for i in range(300)]
    got = run(spark, tmp_path, rows)
    expected, n, explained = brute(rows)
    for k, (deviation, _) in expected.items():
        assert got[k][1].deviation == (deviation if deviation < 1 << 63 else None)
    assert math.isclose(got[0][1].explained, explained[0], rel_tol=1e-12)


def test_sums_of_squares(spark):
    rng = np.random.default_rng(1)
    for most in (10, 1 << 31, 1 << 60):
        u = rng.integers(-most, most, (500, 4))
        exact = [sum(int(c) ** 2 for c in u[:, i]) for i in range(4)]
        assert whitening._column_squares(u) == exact == whitening._column_squares(u.astype(object))
    for value in (0, -1, 1 << 200, -(1 << 200) + 5, (1 << 62) - 1):
        assert sum(p << (60 * i) for i, p in enumerate(whitening._limbs(value))) == value
