"""Approximate nearest neighbours by randomly rotated one-bit codes, with error bounds that choose what to rerank."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from labflow.llm.common import Scratch, ship_package, spread_sample
from labflow.llm.vectors import matrix, rotation, usable

SEED = 20240501
# Standard deviations that a code's estimate may be off before a near vector is missed.
BOUND = 3.0
BLOCK = 8192
QUERY_BLOCK = 128
SAMPLE = 4096
CODED = "part bigint, ids binary, vectors binary, bits binary, norms binary, factors binary"


def fit(vectors, key="vec_id", vector="embedding", sample=SAMPLE):
    """(dimension, centre) of the index: the commonest dimension, and the mean of at most ``sample`` vectors of it.

    The sample is that of the smallest hashes of the key; only the centre, on which no result depends but the tightness
    of the bounds, is learnt from it. None if there is no usable vector.
    """
    rows = usable(vectors, key, vector)
    size = F.size(vector)
    common = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return None
    chosen = spread_sample(rows.where(size == common.d), key, sample).select(vector).collect()
    return common.d, np.mean(np.array([r[0] for r in chosen], "f8"), axis=0)


def encode(x, centre, turn):
    """Packed signs of the rotated residuals, their norms and the inner products of residual and code, all by row."""
    residual = x - centre
    norms = np.linalg.norm(residual, axis=1)
    unit = residual / np.where(norms > 0, norms, 1)[:, None]
    turned = unit @ turn.T
    positive = turned >= 0
    factors = np.abs(turned).sum(1) / np.sqrt(x.shape[1])
    return np.packbits(positive, axis=1), norms, np.where(factors > 0, factors, 1.0)


def estimate(bits, norms, factors, queries, centre, turn, bound=BOUND):
    """Estimated squared distances and their lower bounds, query by row.

    A code holds the signs of a unit residual; its inner product with a query, divided by the code's own inner product
    with the residual, is an unbiased estimate whose error is of the order of one over the root of the dimension.
    """
    d = len(centre)
    residual = queries - centre
    own = np.linalg.norm(residual, axis=1)
    unit = (residual / np.where(own > 0, own, 1)[:, None]) @ turn.T
    signs = (np.unpackbits(bits, axis=1, count=d).astype("f4") * 2 - 1) / np.float32(np.sqrt(d))
    product = (unit.astype("f4") @ signs.T) / factors.astype("f4")
    error = bound * np.sqrt(np.maximum(1 - factors**2, 0)) / factors / np.sqrt(max(d - 1, 1))
    scale = (2 * own[:, None] * norms[None, :]).astype("f4")
    middle = (own[:, None] ** 2 + norms[None, :] ** 2).astype("f4") - scale * product
    return middle, middle - scale * error.astype("f4")


def distances(x, y):
    """Euclidean distances of rows; squares are added from the first component to the last."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        step = x[:, j] - y[:, j]
        total += step * step
    return np.sqrt(total)


def search_block(block, queries, query_ids, k, bound=BOUND):
    """(row of the query, vec_id, distance) of the k nearest in one block.

    Exact distances of the best estimates give a distance that the k-th nearest cannot exceed; every vector whose lower
    bound does not exceed it is reranked by its exact distance.
    """
    ids, x, bits, norms, factors, centre, turn = block
    middle, low = estimate(bits, norms, factors, queries, centre, turn, bound)
    own = ids[None, :] == query_ids[:, None]
    middle[own] = np.inf
    first = min(len(ids), 4 * k)
    best = np.argpartition(middle, first - 1, axis=1)[:, :first]
    found = []
    for i in range(len(queries)):
        near = best[i][~own[i, best[i]]]
        exact = distances(x[near], np.broadcast_to(queries[i], (len(near), x.shape[1])))
        limit = np.partition(exact, k - 1)[k - 1] if len(exact) >= k else np.inf
        # The bounds are in single precision.
        chosen = np.flatnonzero((low[i] <= limit * limit * (1 + 1e-5) + 1e-6) & ~own[i])
        chosen = np.union1d(chosen, near)
        exact = distances(x[chosen], np.broadcast_to(queries[i], (len(chosen), x.shape[1])))
        order = np.lexsort((ids[chosen], exact))[:k]
        found += [(i, int(ids[chosen[j]]), float(exact[j])) for j in order]
    return found


def build_index(vectors, fitted, scratch, key="vec_id", vector="embedding", block=BLOCK):
    """All usable vectors of the fitted dimension as a written table of blocks with codes; returns (table, blocks)."""
    dimension, centre = fitted
    ship_package(vectors.sparkSession)

    def blocks(batches):
        turn = rotation(dimension, SEED)
        for ids, x in _gathered(batches, dimension, block):
            bits, norms, factors = encode(x, centre, turn)
            yield _row( ids=ids, vectors=x.astype("f4"), bits=bits, norms=norms, factors=factors)

    rows = usable(vectors, key, vector).where(F.size(vector) == dimension)
    narrow = rows.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    table, path = scratch.table(
        narrow.mapInArrow(blocks, CODED).withColumn("part", F.monotonically_increasing_id())
    )
    return table


def _gathered(batches, dimension, most):
    """Ids and vectors of Arrow batches, at most ``most`` rows at a time."""
    ids, parts, n = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            piece = batch.slice(start, most)
            if n and n + piece.num_rows > most:
                yield np.concatenate(ids), np.concatenate(parts)
                ids, parts, n = [], [], 0
            ids.append(np.asarray(piece.column(0), dtype="i8"))
            parts.append(matrix(piece.column(1), dimension))
            n += piece.num_rows
    if n:
        yield np.concatenate(ids), np.concatenate(parts)


def _row(**values):
    columns = {"part": pa.array([0], pa.int64())}
    columns |= {k: pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for k, v in values.items()}
    return pa.RecordBatch.from_pydict(columns)


def search(vectors, queries, k=10, key="vec_id", vector="embedding", block=BLOCK, bound=BOUND):
    """The k nearest rows of ``vectors`` for each row of ``queries`` (same columns), by Euclidean distance.

    Returns query_id, rank (from 1), vec_id and score (the distance in double precision), ties to the smaller vec_id.
    Fewer candidates than k give all of them. A query is not its own neighbour; rows that share its id count as itself.
    Vectors that are null, zero, of another dimension than most, or hold null or non-finite components take no part,
    nor do rows without an id. Empty tables give no rows. Other columns are not looked at.

    Every vector is indexed. Blocks of queries are sent to every block of vectors, each task holding one block of
    vectors and one of queries at a time; only k rows for each query and block are shuffled on.
    """
    spark = vectors.sparkSession
    result = "query_id bigint, rank int, vec_id bigint, score double"
    fitted = fit(vectors, key, vector)
    if fitted is None:
        return spark.createDataFrame([], result)
    dimension, centre = fitted
    scratch = Scratch(spark, "nearest")
    index = build_index(vectors, fitted, scratch, key, vector, block)

    def query_blocks(batches):
        for ids, x in _gathered(batches, dimension, QUERY_BLOCK):
            yield _row( ids=ids, vectors=x.astype("f4"))

    asked = usable(queries, key, vector).where(F.size(vector) == dimension)
    narrow = asked.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    grouped, _ = scratch.table(
        narrow.mapInArrow(query_blocks, "part bigint, ids binary, vectors binary").drop("part")
    )
    # The numbers of the index's blocks (one for each ``block`` vectors), for every block of queries to go to.
    parts = ",".join(str(r.part) for r in index.select("part").toLocalIterator())
    empty = F.lit(None).cast("binary")
    meeting = index.withColumn("kind", F.lit(0)).unionByName(
        grouped.select(F.explode(F.split(F.lit(parts), ",").cast("array<bigint>")).alias("part"), "ids", "vectors")
        .select("part", "ids", "vectors", empty.alias("bits"), empty.alias("norms"), empty.alias("factors"), F.lit(1).alias("kind"))
    )

    def nearest(batches):
        turn = rotation(dimension, SEED)
        current = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids = np.frombuffer(row["ids"], "i8")
                x = np.frombuffer(row["vectors"], "f4").reshape(len(ids), dimension).astype("f8")
                if row["kind"] == 0:
                    bits = np.frombuffer(row["bits"], "u1").reshape(len(ids), -1)
                    current = ids, x, bits, np.frombuffer(row["norms"]), np.frombuffer(row["factors"]), centre, turn
                    continue
                found = search_block(current, x, ids, k, bound)
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array([int(ids[f[0]]) for f in found], pa.int64()),
                        "vec_id": pa.array([f[1] for f in found], pa.int64()),
                        "score": pa.array([f[2] for f in found], pa.float64()),
                    }
                )

    # The order of the columns' rows: a block of vectors comes before the blocks of queries that meet it.
    placed = meeting.repartition("part").sortWithinPartitions("part", "kind")
    found = placed.mapInArrow(nearest, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
