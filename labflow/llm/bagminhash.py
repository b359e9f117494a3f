"""Near-duplicate documents by BagMinHash signatures of their word shingles, banding and exact verification."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from labflow.llm import shingles
from labflow.llm.common import Scratch, ship_package, slices
from labflow.llm.components import components
from labflow.llm.shingles import mix

# 30 bands of 5 registers: a pair with a similarity of 0.8 shares no band once in 150,000 times.
BANDS, ROWS = 30, 5
SLICE_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 1000


def _exponential(bits):
    """Exponential random numbers from 64 random bits each."""
    return -np.log(((bits >> np.uint64(11)).astype("f8") + 0.5) * 2.0**-53)


def _draw(element, low, width, step, salt):
    """Random bits that depend on an element, an interval of weights, a step and a use, and on nothing else."""
    with np.errstate(over="ignore"):
        key = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (width * np.uint64(0xC2B2AE3D27D4EB4F))
        return mix(mix(element ^ key) + step * np.uint64(8) + np.uint64(salt))


def signatures(bags, registers=BANDS * ROWS):
    """One row of ``registers`` times for each bag (hashes, whole weights); infinite for an empty bag.

    Every element of weight w has a Poisson process of points over time and the weights from 0 to w, discretised to
    whole levels. A register keeps the earliest of its points, each point falling to a register at random, so the
    share of equal registers of two bags estimates their weighted Jaccard similarity without bias. Levels 0 to 1, 1 to
    2, 2 to 4, 4 to 8 and so on have a process each; one that holds several levels is split at its first point: the
    half that the point falls to keeps it, the other goes on from there at its own rate. Halves above the weight and
    processes that come after the latest register's time are dropped, so large weights cost their logarithm.
    """
    one = np.uint64(1)
    sizes = [len(b[0]) for b in bags]
    times = np.full((len(bags), registers), np.inf)
    if not sum(sizes):
        return times
    flat = times.reshape(-1)
    owner = np.repeat(np.arange(len(bags)), sizes)
    element = np.concatenate([b[0] for b in bags]).astype("u8")
    weight = np.concatenate([b[1] for b in bags]).astype("u8")
    parts = [(owner, element, weight, np.zeros(len(owner), "u8"), np.ones(len(owner), "u8"))]
    low = one
    rest = weight > low
    while rest.any():
        n = int(rest.sum())
        parts.append((owner[rest], element[rest], weight[rest], np.full(n, low), np.full(n, low)))
        low = np.uint64(low * 2)
        rest = weight > low
    owner, element, weight, low, width = (np.concatenate(x) for x in zip(*parts))
    step = np.zeros(len(owner), "u8")
    time = _exponential(_draw(element, low, width, step, 0)) / width
    while len(owner):
        leaf = width == one
        # Single levels: their points go to registers, and the process moves on.
        at = owner[leaf] * registers + (_draw(element[leaf], low[leaf], width[leaf], step[leaf], 1) % np.uint64(registers)).astype("i8")
        np.minimum.at(flat, at, time[leaf])
        step[leaf] += one
        time[leaf] += _exponential(_draw(element[leaf], low[leaf], width[leaf], step[leaf], 0))
        if not leaf.all():
            owner, element, weight, low, width, step, time = _split(leaf, owner, element, weight, low, width, step, time)
        latest = times.max(axis=1)
        keep = time <= latest[owner]
        if not keep.all():
            owner, element, weight, low, width, step, time = (
                x[keep] for x in (owner, element, weight, low, width, step, time)
            )
    return times


def _split(leaf, owner, element, weight, low, width, step, time):
    """Halve every process of several levels; halves that lie above the weight go."""
    wide = ~leaf
    o, e, w, a, half, t = owner[wide], element[wide], weight[wide], low[wide], width[wide] >> np.uint64(1), time[wide]
    upper = (_draw(e, a, width[wide], step[wide], 2) & np.uint64(1)).astype(bool)
    with_point = a + np.where(upper, half, np.uint64(0))
    other = a + np.where(upper, np.uint64(0), half)
    zero = np.zeros(len(o), "u8")
    later = t + _exponential(_draw(e, other, half, zero, 0)) / half
    rows = [
        tuple(x[leaf] for x in (owner, element, weight, low, width, step, time)),
        tuple(x[with_point < w] for x in (o, e, w, with_point, half, zero, t)),
        tuple(x[other < w] for x in (o, e, w, other, half, zero, later)),
    ]
    return tuple(np.concatenate(x) for x in zip(*rows))


def band_keys(times, bands=BANDS, rows=ROWS):
    """One signed 64-bit key for each band of each signature."""
    bits = np.ascontiguousarray(times).view("u8").reshape(len(times), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype="u8"), bits.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key ^ bits[:, :, r])
    return key.view("i8")


def near_duplicates(docs, threshold=0.8, key="doc_id", text="text"):
    """One row per document: doc_id, class_id and kept.

    Two documents are linked if the weighted Jaccard similarity of their bags of five-word shingles is at least
    ``threshold``, or if their texts are equal and hold a word. ``class_id`` is the smallest doc_id reachable by links,
    ``kept`` marks the document that has it. Words are runs of bytes other than ASCII white space. A text of one to four
    words has one shingle, all of it; null texts and texts without words link with nothing. Rows with a null doc_id
    are kept, with a null class. Ids are taken to be unique; rows that share one are one vertex. Other columns are
    ignored; the threshold must not be below the one that the bands are made for, 0.8.

    Steps: signatures of whole texts (no shuffle); equal texts become one class by their SHA-256; classes that share a
    band key are tied to the smallest of them, one row each; the parts that these ties connect are dealt to tasks, large
    ones in blocks that meet pairwise, and their texts verified there. Pairs never leave a task: it returns at most one
    connecting link for each document of its blocks. Inside a task pairs that links already connect need no look, all
    others that share a band are compared exactly.
    """
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "minhash")
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    @F.arrow_udf("array<bigint>")
    def bands(batch: pa.Array) -> pa.Array:
        batch = batch.fill_null("")
        out = []
        for start, end in slices(pa.compute.binary_length(batch).to_pylist(), SLICE_BYTES):
            found = shingles.bags(batch.slice(start, end - start))
            keys = band_keys(signatures(found))
            empty = [not len(b[0]) for b in found]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1), pa.int64()), BANDS)
            out.append(pa.compute.if_else(pa.array(empty), pa.scalar(None, lists.type), lists).cast(pa.list_(pa.int64())))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int64()))

    signed, _ = scratch.table(
        rows.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), bands("text").alias("bands"))
    )
    able = signed.where("doc_id IS NOT NULL AND bands IS NOT NULL")
    classes, _ = scratch.table(
        able.groupBy("digest")
        .agg(F.min(F.struct("doc_id", "bands")).alias("first"), F.count(F.lit(1)).alias("n"))
        .select("digest", "n", F.col("first.doc_id").alias("rep"), F.col("first.bands").alias("bands"))
    )
    entries = classes.select("rep", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = entries.join(shared, "band").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    parts = components(ties.distinct(), scratch)
    members, _ = scratch.table(
        classes.select("rep", "bands")
        .join(parts, F.col("rep") == F.col("node"))
        .join(rows.where("doc_id IS NOT NULL"), F.col("doc_id") == F.col("rep"))
        .select("rep", "component", "bands", "text")
    )
    totals = members.groupBy("component").agg(
        F.ceil(
            F.greatest(F.sum(F.octet_length("text")) / BLOCK_BYTES, F.count(F.lit(1)) / BLOCK_DOCS)
        ).cast("int").alias("split")
    )
    met = (
        members.join(totals, "component")
        .withColumn("side", F.pmod(F.xxhash64("rep"), F.col("split")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("split") - 1)))
        .withColumn("low", F.least("side", "other"))
        .withColumn("high", F.greatest("side", "other"))
    )
    group = ["component", "low", "high"]
    dealt = met.repartition(*group).sortWithinPartitions(*group).select(*group, "side", "rep", "bands", "text")
    links, _ = scratch.table(dealt.mapInArrow(lambda batches: _verified(batches, threshold), "a bigint, b bigint"))
    found = components(links, scratch)
    several = classes.where("n > 1").select("digest", "rep")
    return (
        signed.select("doc_id", F.when(F.col("bands").isNotNull(), F.col("digest")).alias("digest"))
        .join(several, "digest", "left")
        .withColumn("rep", F.coalesce("rep", "doc_id"))
        .join(found, F.col("rep") == F.col("node"), "left")
        .select("doc_id", F.coalesce("component", "rep").alias("class_id"))
        .select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
    )


def _verified(batches, threshold):
    """Connecting links of each group of rows; groups come in a row and have a bounded size."""
    current, rows = None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece = batch.slice(start, 256)
            keys = list(zip(*(piece.column(c).to_pylist() for c in ("component", "low", "high"))))
            bounds = [i for i in range(len(keys)) if i and keys[i] != keys[i - 1]]
            for a, b in zip([0, *bounds], [*bounds, len(keys)]):
                if keys[a] != current and rows:
                    yield _links(pa.Table.from_batches(rows), threshold)
                    rows = []
                current = keys[a]
                # A copy, or else the whole batch stays in memory.
                rows.append(piece.slice(a, b - a).take(pa.array(range(b - a))))
    if rows:
        yield _links(pa.Table.from_batches(rows), threshold)


def _links(table, threshold):
    table = table.combine_chunks()
    ids = np.asarray(table["rep"].combine_chunks())
    sides = np.asarray(table["side"].combine_chunks())
    texts = table["text"].combine_chunks()
    bands = np.stack([np.asarray(x.values) for x in table["bands"].combine_chunks()])
    found = shingles.bags(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts)
    totals = np.array([b[1].sum() for b in found])
    across = table["low"][0].as_py() != table["high"][0].as_py()
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    made = []
    for i in range(len(ids) - 1):
        same = (bands[i + 1 :] == bands[i]).sum(1)
        near = same > 0
        if across:
            near &= sides[i + 1 :] != sides[i]
        rest = totals[i + 1 :]
        near &= np.minimum(rest, totals[i]) >= threshold * np.maximum(rest, totals[i])
        js = np.flatnonzero(near)
        for j in js[np.argsort(-same[js], kind="stable")] + i + 1:
            a, b = root(i), root(int(j))
            if a != b and shingles.overlap(found[i], found[j]) >= threshold:
                parent[b] = a
                made.append((int(ids[i]), int(ids[j])))
    return pa.RecordBatch.from_pydict(
        {"a": pa.array([m[0] for m in made], pa.int64()), "b": pa.array([m[1] for m in made], pa.int64())}
    )
