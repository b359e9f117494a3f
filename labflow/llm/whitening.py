"""Whitening of embeddings with a covariance from variances alone.

The covariance comes from polarisation: sums of squared centred values of every dimension and of every sum of two
dimensions are aggregated exactly, and 2 cov(a, b) = var(a + b) - var(a) - var(b). Tasks reduce their rows to these sums,
whose number depends on the dimension only; the matrix is assembled and taken apart on the driver.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from labflow.llm.common import Scratch, ship_package, with_columns

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
# Entries from here on have no exact place on the grid.
LARGEST = float(1 << 55)
# Rows worked on at a time.
ROWS = 4096
# Sums of squares travel as limbs of so many bits, as a sum may outgrow every number type of Spark.
LIMB = 60
# Of the trace; a component with less variance than this has no direction.
LEAST_VARIANCE = 1e-12


@dataclass
class Whitening:
    """A fitted whitening: ``count`` vectors with per-dimension ``sums``; per component its unit eigenvector, eigenvalue
    (0 if it has no variance), and share of the trace; and the largest error of the whitened covariance."""

    count: int
    sums: list
    vectors: np.ndarray
    values: np.ndarray
    explained: list
    identity_error: float | None


def on_grid(vectors, vector="embedding", out="x"):
    """Rows with ``out``: every entry c as the integer floor(64 c) + 1,000,000 (array<bigint>).

    Rows whose vector is null, empty, or holds null or non-finite entries or one of 2^55 or more are left out, and so are
    vectors of another length than the most frequent one (of several, the shortest). A column ``out`` gives way.
    """
    v = F.col(f"`{vector}`")
    # Not a number compares as larger than any number.
    finite = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < LARGEST))
    usable = vectors.where(v.isNotNull() & (F.size(v) > 0) & finite)
    most = usable.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").first()
    grid = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + F.lit(OFFSET))
    return with_columns(usable.where(F.size(v) == (most.d if most else 0)), {out: grid})


def fit(rows, x="x", components=COMPONENTS, scratch=None):
    """Whitening of the distinct vectors of ``rows`` (array<bigint>, all of one length, see ``on_grid``).

    Repeated vectors count once. Covariances have the number of distinct vectors as divisor. Up to ``components``
    components are kept, by falling eigenvalue. Components without variance (constant or dependent dimensions, or fewer
    vectors than dimensions) have eigenvalue 0 and no direction. An empty table has no components. Three passes over the
    distinct vectors, written once; the driver receives one number per dimension and per pair of dimensions.
    """
    spark = rows.sparkSession
    ship_package(spark)
    own = scratch or Scratch(spark, "whitening")
    # Copies combine before the shuffle.
    distinct, path = own.table(rows.select(F.col(f"`{x}`").alias("x")).groupBy("x").agg(F.lit(1).alias("one")).select("x"))
    first = _collected(distinct, _sums)
    count = int(first.pop(-1, 0))
    if not count:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), [], None)
    sums = [first.get(i, 0) for i in range(len(first))] if len(first) else []
    squares = _collected(distinct, lambda m: _squares(_centred(m, count, sums)))
    covariance, trace = _assembled(squares, len(sums), count)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order].T.copy()
    values = np.where(values > LEAST_VARIANCE * trace, values, 0.0)
    explained = [float(e / trace) if trace else None for e in values]
    model = Whitening(count, sums, vectors, values, explained, None)
    model.identity_error = _identity_error(distinct, model)
    own.drop(path)
    return model


def whiten(rows, model, x="x"):
    """Add ``deviation`` (bigint: sum of the squares of n x - S, exact; null if it does not fit) and ``whitened``
    (array<double>: the projections on the components over the roots of their eigenvalues; null for a component without
    direction). Rows are those of ``on_grid``; columns of those names give way."""
    ship_package(rows.sparkSession)

    @F.arrow_udf("struct<deviation: bigint, whitened: array<double>>")
    def placed(batch: pa.Array) -> pa.Array:
        deviations, whitened = [], []
        for start in range(0, len(batch), ROWS):
            d = _centred(_matrix(batch.slice(start, ROWS)), model.count, model.sums)
            deviations += _row_squares(d)
            y = _projected(d, model)
            whitened += [[None if np.isnan(c) else c for c in row] for row in y.tolist()]
        return pa.StructArray.from_arrays(
            [
                pa.array([s if s < 1 << 63 else None for s in deviations], pa.int64()),
                pa.array(whitened, pa.list_(pa.float64())),
            ],
            ["deviation", "whitened"],
        )

    kept = [c for c in rows.columns if c.lower() not in ("deviation", "whitened", "_placed")]
    found = rows.select(*[F.col(f"`{c}`") for c in kept], placed(F.col(f"`{x}`")).alias("_placed"))
    return found.select(*[F.col(f"`{c}`") for c in kept], "_placed.*")


# ---- inside a task --------------------------------------------------------------------------------------------


def _matrix(array):
    """Lists of one length without nulls as a matrix of 64-bit integers."""
    flat = np.asarray(array.flatten(), dtype="i8")
    return flat.reshape(len(array), len(flat) // max(len(array), 1))


def _centred(m, count, sums):
    """n x - S, exactly: 64-bit integers where all fit with room for a sum of two, else Python's."""
    base = [s // count for s in sums]
    rest = [s - count * b for s, b in zip(sums, base)]
    if m.size and m.dtype != object:
        low, high = m.min(0).tolist(), m.max(0).tolist()
        reach = max(max(abs(h - b), abs(lo - b)) for lo, h, b in zip(low, high, base))
        if (reach + 1) * count < 1 << 61:
            return (m - np.array(base, "i8")) * np.int64(count) - np.array(rest, "i8")
    return (m.astype(object) - np.array(base, object)) * count - np.array(rest, object)


def _column_squares(u):
    """Exact sum of squares of every column, as Python integers."""
    if u.dtype == object:
        return [int(c) for c in (u * u).sum(0)] if len(u) else [0] * u.shape[1]
    most = int(np.abs(u).max(initial=0))
    if most * most * max(len(u), 1) < 1 << 63:
        return np.einsum("ij,ij->j", u, u).tolist()
    mask, found = (1 << 21) - 1, [0] * u.shape[1]
    limbs = [u & mask, (u >> 21) & mask, u >> 42]
    for i in range(3):
        for j in range(i, 3):
            weight = (1 if i == j else 2) << (21 * (i + j))
            for c, s in enumerate(np.einsum("ij,ij->j", limbs[i], limbs[j]).tolist()):
                found[c] += weight * s
    return found


def _row_squares(d):
    return _column_squares(np.ascontiguousarray(d.T)) if len(d) else []


def _sums(m):
    """Sum of every dimension, and the number of rows under -1."""
    yield -1, len(m)
    for i, s in enumerate(m.astype(object).sum(0) if np.abs(m).max(initial=0) >> 50 else m.sum(0).tolist()):
        yield i, int(s)


def _squares(d):
    """Sums of squares: of dimension a under a * size + a, of the sum of dimensions a < b under a * size + b."""
    size = d.shape[1]
    for a in range(size):
        u = d[:, a:].copy()
        u[:, 1:] += d[:, a : a + 1]
        for b, s in enumerate(_column_squares(u)):
            yield a * size + a + b, s


def _projected(d, model):
    """Whitened values of centred rows; not a number for components without direction."""
    with np.errstate(divide="ignore", invalid="ignore"):
        y = (d / model.count).astype("f8") @ model.vectors.T
        return np.where(model.values > 0, y / np.sqrt(model.values), np.nan)


# ---- aggregates -----------------------------------------------------------------------------------------------


def _collected(vectors, of_rows):
    """Exact totals by key over all rows; ``of_rows`` gives (key, integer) of a matrix. Tasks send one set each."""

    def totals(batches):
        found = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                for key, value in of_rows(_matrix(batch.column(0).slice(start, ROWS))):
                    found[key] = found.get(key, 0) + value
        rows = [(key, limb, part) for key, value in found.items() for limb, part in enumerate(_limbs(value))]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64()))] if rows else []
        if columns:
            yield pa.RecordBatch.from_arrays(columns, ["key", "limb", "part"])

    parts = vectors.mapInArrow(totals, "key bigint, limb int, part bigint")
    found = {}
    for r in parts.groupBy("key", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s")).collect():
        found[r.key] = found.get(r.key, 0) + (int(r.s) << (LIMB * r.limb))
    return found


def _limbs(value):
    """An integer in pieces of ``LIMB`` bits, the last one signed."""
    while not -(1 << 62) <= value < 1 << 62:
        yield value & ((1 << LIMB) - 1)
        value >>= LIMB
    yield value


def _assembled(squares, size, count):
    """(covariance matrix, trace): every entry is one correctly rounded quotient of integers."""
    covariance, cube = np.zeros((size, size)), count**3
    for a in range(size):
        covariance[a, a] = squares[a * size + a] / cube
        for b in range(a + 1, size):
            twice = squares[a * size + b] - squares[a * size + a] - squares[b * size + b]
            covariance[a, b] = covariance[b, a] = twice / (2 * cube)
    return covariance, sum(squares[a * size + a] for a in range(size)) / cube


def _identity_error(distinct, model):
    """Largest absolute entry of the whitened covariance less the identity, over components with a direction."""
    alive = np.flatnonzero(model.values > 0)
    if not len(alive):
        return None

    def summed(of_rows):
        def totals(batches):
            total = None
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS):
                    m = _matrix(batch.column(0).slice(start, ROWS))
                    y = _projected(_centred(m, model.count, model.sums), model)[:, alive]
                    found = of_rows(y).ravel()
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["key", "part"])

        rows = distinct.mapInArrow(totals, "key int, part double").groupBy("key").agg(F.sum("part").alias("s")).collect()
        return np.array([r.s for r in sorted(rows, key=lambda r: r.key)])

    mean = summed(lambda y: y.sum(0)) / model.count
    products = summed(lambda y: (y - mean).T @ (y - mean)) / model.count
    return float(np.abs(products.reshape(len(alive), len(alive)) - np.eye(len(alive))).max())
