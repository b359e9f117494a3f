"""Near-duplicate vectors by spherical-cap filters from a structured random product code."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from labflow.llm.common import Scratch, ship_package
from labflow.llm.components import components
from labflow.llm.vectors import matrix, rotation, usable

SEED = 7
# Independent codes. The number of filters that a near pair shares varies much from pair to pair within one code, less
# over several; with these figures no pair out of thousands at the threshold shares none.
CODES = 6
# Filters of one code that a pair at the threshold shares on average.
SHARED = 6
# Directions per half of a code, as a multiple of the root of the number of vectors: buckets stay small as data grows.
PER_ROOT = 8
LEAST_DIRECTIONS, MOST_DIRECTIONS = 256, 16384
BLOCK = 512
TRIAL_PAIRS = 32


class Code:
    """Filter directions (c1, c2) for c1 and c2 out of random unit vectors of each half of the rotated space.

    A vector's inner product with a filter direction is the sum of two, so the filters that exceed the cap's height
    come out of two short lists of inner products, without a look at all pairs of directions.
    """

    def __init__(self, dimension, directions, seed):
        rng = np.random.default_rng(seed)
        self.turn = rotation(dimension, seed)
        self.half = max(1, dimension // 2)
        self.parts = []
        for width in (self.half, dimension - self.half):
            c = rng.standard_normal((directions, width))
            self.parts.append((c / np.maximum(np.linalg.norm(c, axis=1), 1e-12)[:, None]).astype("f4"))
        self.directions = directions

    def products(self, unit):
        turned = (unit @ self.turn.T).astype("f4")
        return turned[:, : self.half] @ self.parts[0].T, turned[:, self.half :] @ self.parts[1].T

    def filters(self, unit, height):
        """Ascending numbers of the filters whose inner product with each unit vector is at least the height."""
        for start in range(0, len(unit), 256):
            a, b = self.products(unit[start : start + 256])
            high_a, high_b = a.max(1), b.max(1)
            for i in range(len(a)):
                rows = np.flatnonzero(a[i] >= height - high_b[i])
                columns = np.flatnonzero(b[i] >= height - high_a[i])
                r, c = np.nonzero(a[i][rows][:, None] + b[i][columns][None, :] >= height)
                yield rows[r] * self.directions + columns[c]


def calibrated(dimension, directions, threshold, shared=SHARED, pairs=TRIAL_PAIRS):
    """The height at which random pairs with a cosine at the threshold share ``shared`` filters of a code on average."""
    rng = np.random.default_rng(SEED)
    u = rng.standard_normal((pairs, dimension))
    u /= np.linalg.norm(u, axis=1)[:, None]
    w = rng.standard_normal((pairs, dimension))
    w -= (w * u).sum(1)[:, None] * u
    w /= np.maximum(np.linalg.norm(w, axis=1), 1e-12)[:, None]
    code = Code(dimension, directions, SEED)
    (a1, b1), (a2, b2) = code.products(u), code.products(threshold * u + np.sqrt(1 - threshold**2) * w)
    sums = []
    for i in range(pairs):
        # Sums this high have both parts among the highest.
        r = np.argsort(a1[i] + a2[i])[-max(64, directions // 5) :]
        c = np.argsort(b1[i] + b2[i])[-max(64, directions // 5) :]
        both = np.minimum(a1[i][r][:, None] + b1[i][c], a2[i][r][:, None] + b2[i][c]).ravel()
        keep = min(len(both), 20 * shared)
        sums.append(np.partition(both, len(both) - keep)[len(both) - keep :])
    sums = np.sort(np.concatenate(sums))
    return float(sums[-min(len(sums), shared * pairs)])


class Decoder:
    """All codes of one dimension."""

    def __init__(self, dimension, directions, height, codes=CODES):
        self.codes = [Code(dimension, directions, SEED + k) for k in range(codes)]
        self.height = height

    def filters(self, x):
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        for parts in zip(*(code.filters(unit, self.height) for code in self.codes)):
            yield np.concatenate([part + k * code.directions**2 for k, (part, code) in enumerate(zip(parts, self.codes))])


def link_block(ids, weights, unit, lists, sides, f, threshold):
    """Links inside one bucket, or between two blocks of it, that no smaller common filter shows as well.

    Returns (id, weight of the linked classes) pairs and pairs of ids that connect what is linked. ``sides``: block
    of each row; with two blocks only pairs across them count.
    """
    cosine = unit @ unit.T
    linked = cosine >= threshold
    across = sides[:, None] != sides[None, :] if sides[0] != sides[-1] else ~np.eye(len(ids), dtype=bool)
    linked &= across & (ids[:, None] != ids[None, :])
    rows = np.flatnonzero(linked.any(1))
    if not len(rows):
        return [], []
    linked = linked[np.ix_(rows, rows)]
    ids, weights, lists = ids[rows], weights[rows], [lists[i] for i in rows]
    edges = _forest(ids, linked)
    # Smaller filters that two rows share: the pair is counted there.
    smaller = [own[own < f] for own in lists]
    known = np.unique(np.concatenate(smaller))
    if len(known):
        member = np.zeros((len(ids), len(known)), "f4")
        for i, own in enumerate(smaller):
            member[i, np.searchsorted(known, own)] = 1
        linked &= member @ member.T == 0
    sums = linked @ weights
    return [(int(ids[i]), int(sums[i])) for i in np.flatnonzero(sums)], edges


def _forest(ids, linked):
    """Each id of a connected part paired with the smallest one."""
    left, edges = np.ones(len(ids), bool), []
    while left.any():
        part = np.zeros(len(ids), bool)
        part[np.argmax(left)] = True
        grown = part
        while grown.any():
            grown = linked[grown].any(0) & ~part
            part |= grown
        left &= ~part
        least = ids[part].min()
        edges += [(int(i), int(least)) for i in ids[part] if i != least]
    return edges


def near_duplicates(vectors, threshold=0.93, key="vec_id", vector="embedding", label="label", block=BLOCK):
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Two rows link if their labels are equal and not null and the cosine of their vectors, in double precision, is at
    least ``threshold``. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest vec_id
    reachable by links and ``kept`` marks the row that has it. Rows with a null id or label, or a vector that is null,
    zero, or holds null or non-finite components link with nothing (n_links 0, own id, kept). Vectors of different
    dimensions do not link. Ids are taken to be unique; rows that share one are one vertex. Other columns are ignored.

    Equal vectors of a label become one class with a weight. Each class is decoded to its filters; filters with one
    class fall away before vectors are sent to the others. A bucket of more than ``block`` classes is split into blocks
    that meet pairwise, so no task holds more than about two blocks of it. A pair is counted under its smallest common
    filter only, and only sums and connecting pairs leave a task, at most one of each for every row of a block.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "caps")
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<float>").alias("v"), F.col(label).alias("label")
    )
    able = usable(rows, "vec_id", "v").where("label IS NOT NULL")
    classes, _ = scratch.table(
        able.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    )
    number = classes.count()
    directions = int(min(MOST_DIRECTIONS, max(LEAST_DIRECTIONS, PER_ROOT * np.sqrt(number))))
    heights = {
        r.d: calibrated(r.d, directions, threshold) for r in classes.select(F.size("v").alias("d")).distinct().collect()
    }
    decoders = {}

    # Numbers of filters stay below 2^31 with ``CODES`` codes of ``MOST_DIRECTIONS`` squared filters each.
    @F.arrow_udf("array<int>")
    def decoded(batch: pa.Array) -> pa.Array:
        out = [None] * len(batch)
        sizes = np.asarray(pa.compute.list_value_length(batch))
        for d in np.unique(sizes):
            if d not in decoders:
                decoders[d] = Decoder(int(d), directions, heights[d])
            at = np.flatnonzero(sizes == d)
            for i, own in zip(at, decoders[d].filters(matrix(batch.take(pa.array(at)), int(d)))):
                out[i] = own.astype("i4")
        return pa.array(out, pa.list_(pa.int32()))

    lists, _ = scratch.table(classes.withColumn("filters", decoded("v")).withColumn("d", F.size("v")))
    entries = lists.select("label", "d", F.explode("filters").alias("f"), "rep")
    shared = entries.groupBy("label", "d", "f").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    live = (
        entries.join(shared, ["label", "d", "f"])
        .groupBy("rep")
        .agg(F.collect_list(F.struct("f", "n")).alias("live"))
    )
    split = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), split).cast("int")
    met = (
        lists.drop("filters")
        .join(live, "rep")
        # Filters that two classes share are live in both, so the others need not travel.
        .select("rep", "m", "v", F.col("live.f").alias("filters"), F.xxhash64("label", "d").alias("space"), F.explode("live").alias("x"))
        .select("rep", "m", "v", "filters", "space", "x.f", "x.n")
        .withColumn("side", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), split - 1)))
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
    )
    group = ["space", "f", "low", "high"]
    dealt = met.repartition(*group).sortWithinPartitions(*group, "side").select(*group, "side", "rep", "m", "v", "filters")
    found, _ = scratch.table(dealt.mapInArrow(lambda batches: _linked(batches, threshold), "a bigint, b bigint, n bigint"))
    sums = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    parts = components(found.where("b IS NOT NULL").select("a", "b"), scratch)
    several = classes.where("m > 1")
    named = (
        able.join(several, ["label", "v"], "left")
        .select("vec_id", F.coalesce("rep", "vec_id").alias("rep"), F.coalesce("m", F.lit(1)).alias("m"))
        .join(sums, "rep", "left")
        .join(parts, F.col("rep") == F.col("node"), "left")
        .select(
            "vec_id",
            (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    # The rest is what ``able`` leaves out.
    ok = F.col("v").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    alone = rows.where(~F.coalesce(ok & finite, F.lit(False))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return named.unionByName(alone).withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))


def _linked(batches, threshold):
    """Sums (a, null, n) and connecting pairs (a, b, 0) of the groups, which come in a row."""
    kept = None
    for batch in batches:
        if kept is not None:
            batch = pa.concat_batches([kept, batch])
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(c), "i8") for c in ("space", "f", "low", "high")], axis=1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        last = int(starts[-1])
        if last:
            yield _of_groups(batch.slice(0, last), starts, keys, threshold)
        # Copied, or else the whole batch stays in memory.
        kept = pa.concat_batches([batch.slice(last).take(pa.array(range(batch.num_rows - last)))])
    if kept is not None and kept.num_rows:
        keys = np.array([[0, kept.column("f")[0].as_py()]])
        yield _of_groups(kept, np.array([0]), keys, threshold)


def _of_groups(batch, starts, keys, threshold):
    ids, weights = np.asarray(batch.column("rep"), "i8"), np.asarray(batch.column("m"), "i8")
    sides, vectors, filters = np.asarray(batch.column("side")), batch.column("v"), batch.column("filters")
    a, b, n = [], [], []
    bounds = [int(s) for s in starts if s < batch.num_rows] + [batch.num_rows]
    for start, end in zip(bounds, bounds[1:]):
        if end - start < 2:
            continue
        x = matrix(vectors.slice(start, end - start), len(vectors[start]))
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        if end - start == 2 and unit[0] @ unit[1] < threshold - 1e-9:
            continue
        lists = [np.asarray(filters[i].values) for i in range(start, end)]
        sums, edges = link_block(
            ids[start:end], weights[start:end], unit, lists, sides[start:end], keys[start][1], threshold
        )
        a += [s[0] for s in sums] + [e[0] for e in edges]
        b += [None] * len(sums) + [e[1] for e in edges]
        n += [s[1] for s in sums] + [0] * len(edges)
    return pa.RecordBatch.from_pydict(
        {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())}
    )
