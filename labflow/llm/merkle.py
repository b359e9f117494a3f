"""Merkle manifest of a dataset: digests of rows, a hash tree for each group, one over the groups, and proofs.

Every node is labelled with the interval of leaf ranks that it covers and with that of its parent. Levels are dealt with
in bands: the nodes of a band below one ancestor are one row, at most ``fan ** BAND`` leaves of a small tree, whatever
the size of a group. Ancestors above a band are attached by a join on the band's interval; siblings are the nodes whose
interval lies in that of a parent but is not the one that leads there. DataFrame functions only.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labflow.llm.common import Scratch

# Levels of a band: a row of a band holds the digests of at most 2 ** 6 nodes and of what lies between.
BAND = 6
# More blocks than tasks, so that blocks dealt out by hash fill the tasks evenly.
BLOCKS_PER_TASK = 4
NODE = "struct<level:int,lo:bigint,hi:bigint,parent_lo:bigint,parent_hi:bigint,digest:string>"


def leaf_digest(*fields):
    """Lowercase hex SHA-256 of fields in a row: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def fold(digest, proof):
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda own, x: F.sha2(F.concat(x.before, own, x.after), 256))


def proof_digest(proof):
    """Digest of all siblings of a proof, level by level from the leaf on, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda x: F.concat(x.before, x.after)), ""), 256)


@dataclass
class Manifest:
    """``rows``: the leaves with ``subroot``, ``root`` and ``proof``; ``nodes``: all nodes; ``root``: None without rows."""

    rows: DataFrame
    nodes: DataFrame
    root: str | None


def manifest(rows, key="doc_id", group="lang", digest="leaf", fan=2, scratch=None):
    """Hash tree over rows that already carry their digest.

    Per ``group`` (null is a group of its own) leaves ascend by ``key``, nulls first, rows of the same key by digest;
    repeated rows are leaves of their own. While several nodes remain, every ``fan`` consecutive ones (the last run may
    have fewer, even one) become the digest of their hex digests in a row. What remains is the group's subroot, and
    subroots, ordered by group (null first, else by UTF-8 bytes), give the root in the same way.

    ``rows`` of the result are the input's columns and ``subroot``, ``root`` and ``proof``: per level up to the root the
    hex digests ``before`` and ``after`` the own node in its run. Columns of those names in the input give way. ``nodes``
    are (group, level, lo, hi, digest), the interval being that of the leaf ranks covered; the tree over the groups has
    ``over_groups`` true and a null group. An empty table has no rows, no nodes and the root None. Both are read from
    tables in ``scratch``, which the caller may clear when done.
    """
    spark = rows.sparkSession
    scratch = scratch or Scratch(spark, "merkle")
    made = ("subroot", "root", "proof")
    kept = [c for c in rows.columns if c.lower() not in made]
    own = F.col(f"`{group}`").cast("string")
    leaves = rows.select(
        # Never null, and in the order of the groups.
        F.when(own.isNull(), "").otherwise(F.concat(F.lit("="), own)).alias("g"),
        F.col(f"`{key}`").alias("at"),
        F.col(f"`{digest}`").alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("payload"),
    )
    bands = _bands(leaves, scratch, fan)
    tops = _last_parts(bands, fan).select("g", F.col("top").alias("digest"))
    groups = tops.select(F.lit("").alias("g"), F.col("g").alias("at"), "digest", F.struct("g", "digest").alias("payload"))
    upper = _bands(groups, scratch, fan)
    last = _last_parts(upper, fan).select("top").first()
    root = last.top if last else None
    none = F.expr("cast(array() as array<struct<before:string,after:string>>)")
    everything = spark.range(1).select(F.lit("").alias("g"), none.alias("proof"), F.lit(root).cast("string").alias("subroot"))
    over = _proofs(upper, everything, fan).select("payload.g", "proof", F.col("payload.digest").alias("subroot"))
    found = _proofs(bands, over, fan)
    of_group = F.when(F.col("g") != "", F.substring("g", 2, 1 << 30))
    label = [F.col(f"node.{c}").alias(c) for c in ("level", "lo", "hi", "digest")]
    return Manifest(
        rows=found.select("payload.*", "subroot", F.lit(root).cast("string").alias("root"), "proof"),
        nodes=_nodes(bands, fan)
        .select(of_group.alias(group), F.lit(False).alias("over_groups"), *label)
        .unionByName(
            _nodes(upper, fan).select(F.lit(None).cast("string").alias(group), F.lit(True).alias("over_groups"), *label)
        ),
        root=root,
    )


def _power(fan, k):
    """A power that stays a long."""
    return min(fan**k, 1 << 62)


def _long(value):
    return F.lit(value).cast("bigint")


def _ranked(leaves, scratch):
    """Add ``rank`` of a leaf in its group, from 0, and ``n``, the group's leaves; the second result is the table read.

    Leaves are range-partitioned by group and order, so the largest group is spread over many blocks; counts of the
    blocks give each its first rank.
    """
    blocks = BLOCKS_PER_TASK * int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Range partitioning reads its input twice; texts are read once.
    narrow, first = scratch.table(leaves)
    order = ["at", "digest", "nth"]
    laid, path = scratch.table(
        narrow.withColumn("nth", F.monotonically_increasing_id())
        .repartitionByRange(blocks, "g", *order)
        .withColumn("block", F.spark_partition_id())
    )
    scratch.drop(first)
    counts = laid.groupBy("g", "block").agg(F.count(F.lit(1)).alias("size"))
    of_group = Window.partitionBy("g")
    before = of_group.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "g", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"), F.sum("size").over(of_group).alias("n")
    )
    inside = Window.partitionBy("g", "block").orderBy(*order)
    ranked = (
        laid.withColumn("place", F.row_number().over(inside).cast("bigint") - 1)
        .join(starts, ["g", "block"])
        .select("g", "n", (F.col("first") + F.col("place")).alias("rank"), "digest", "payload")
    )
    return ranked, path


def _bands(leaves, scratch, fan):
    """One written table per band of levels, from the leaves up.

    A row is the part of a band below one node: ``base`` (its lowest nodes in order, with what leaves carry), ``nodes``
    (all nodes of the band but the top one, with their intervals), ``top`` (digest), ``lo`` and ``hi``.
    """
    base, path = _ranked(leaves, scratch)
    tables = []
    while True:
        k = len(tables)
        reach = _power(fan, BAND * (k + 1))
        carried = ["rank", "digest", *(["payload"] if k == 0 else [])]
        in_order = lambda a, b: F.when(a["rank"] < b["rank"], -1).otherwise(1)
        parts = base.groupBy("g", "n", F.expr(f"rank div {fan**BAND}").alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct(*carried)), in_order).alias("base")
        )
        built = parts.withColumn("built", _built(k * BAND, fan))
        lo = F.col("bucket") * _long(reach)
        hi = F.least(lo + _long(reach), F.col("n")) - 1
        table, _ = scratch.table(
            built.select("g", "n", "bucket", lo.alias("lo"), hi.alias("hi"), "base", "built.nodes", "built.top")
        )
        tables.append(table)
        if k == 0:
            scratch.drop(path)
        base = table.where(F.col("n") > reach).select("g", "n", F.col("bucket").alias("rank"), F.col("top").alias("digest"))
        if base.isEmpty():
            return tables


def _last_parts(bands, fan):
    """The part of each group that holds its last node."""
    found = [b.where(F.col("n") <= _power(fan, BAND * (k + 1))) for k, b in enumerate(bands)]
    return reduce(DataFrame.unionByName, [b.select("g", "n", "top") for b in found])


def _height(fan):
    """Levels above the leaves of a tree of n leaves."""
    powers = sorted({_power(fan, k) for k in range(63)})
    return F.size(F.filter(F.array(*[_long(p) for p in powers]), lambda p: p < F.col("n")))


def _levels(level, fan):
    """Levels from ``level`` on, within a band, that have a level above them."""
    all_of_them = F.sequence(F.lit(level), F.lit(level + BAND - 1))
    return F.slice(all_of_them, F.lit(1), F.greatest(F.least(_height(fan) - level, F.lit(BAND)), F.lit(0)))


def _built(level, fan):
    """Nodes and top of one part of the band that starts at a level; ``base`` holds its lowest nodes."""

    def by_level(power):
        values = F.array(*[_long(_power(fan, power(i))) for i in range(BAND)])
        return lambda at: F.element_at(values, at - level + 1)

    spans, parents = by_level(lambda i: level + i), by_level(lambda i: level + i + 1)
    per_part = by_level(lambda i: BAND - i)

    def step(state, at):
        first = F.col("bucket") * per_part(at)

        def node(digest, i):
            lo = (first + i) * spans(at)
            parent = lo - lo % parents(at)
            return F.struct(
                at.alias("level"),
                lo.alias("lo"),
                (F.least(lo + spans(at), F.col("n")) - 1).alias("hi"),
                parent.alias("parent_lo"),
                (F.least(parent + parents(at), F.col("n")) - 1).alias("parent_hi"),
                digest.alias("digest"),
            )

        runs = F.sequence(F.lit(0), F.floor((F.size(state.own) - 1) / F.lit(fan)).cast("int"))
        joined = F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(state.own, r * fan + 1, F.lit(fan)), ""), 256))
        return F.struct(joined.alias("own"), F.concat(state.nodes, F.transform(state.own, node)).alias("nodes"))

    none = F.expr(f"cast(array() as array<{NODE}>)")
    start = F.struct(F.transform("base", lambda x: x.digest).alias("own"), none.alias("nodes"))
    last = lambda s: F.struct(s.nodes.alias("nodes"), F.element_at(s.own, 1).alias("top"))
    return F.aggregate(_levels(level, fan), start, step, last)


def _proofs(bands, groups, fan):
    """(payload, proof, subroot) of every leaf; ``groups`` has (g, proof, subroot) of each group's last node.

    From the top band down: the proof of a node is joined to the part of the band below that the node's interval
    contains, and siblings inside the part go before it.
    """
    above = None
    for k in reversed(range(len(bands))):
        reach, unit = _power(fan, BAND * (k + 1)), _power(fan, BAND * k)
        # The last node of a group covers all its leaves.
        whole = bands[k].where(F.col("n") <= reach).join(groups.select("g", "proof", "subroot"), "g")
        parts = whole if above is None else whole.unionByName(_inside(bands[k].where(F.col("n") > reach), above, reach))
        with_proof = F.transform("base", lambda x: _with_proof(x, _levels(k * BAND, fan), unit))
        found = parts.select("g", "n", "subroot", F.explode(with_proof).alias("x"))
        lo = F.col("x.base.rank") * _long(unit)
        above = found.select(
            "g",
            "subroot",
            lo.alias("node_lo"),
            (F.least(lo + _long(unit), F.col("n")) - 1).alias("node_hi"),
            "x.proof",
            *(["x.base.payload"] if k == 0 else []),
        )
    return above.select("payload", "proof", "subroot")


def _inside(parts, above, reach):
    """Containment join of parts of a band with the nodes of the band above whose intervals hold them.

    Both are dealt out by group and by the bucket of ranks that a node of that level covers, so each part meets one node.
    """
    nodes = above.select("g", F.expr(f"node_lo div {reach}").alias("bucket"), "node_lo", "node_hi", "proof", "subroot")
    met = parts.join(nodes, ["g", "bucket"]).where("node_lo <= lo AND hi <= node_hi")
    return met.select(*parts.columns, "proof", "subroot")


def _with_proof(x, levels, unit):
    """A lowest node of a part and its proof: its siblings in the part, then what the part's top node brings."""
    at = x["rank"] * _long(unit)
    # What is left of a parent's interval without the node that leads to x.
    others = F.filter(
        "nodes", lambda y: (y.parent_lo <= at) & (at <= y.parent_hi) & ~((y.lo <= at) & (at <= y.hi))
    )

    def of_level(found, level):
        def side(left):
            own = F.filter(found, lambda y: (y.level == level) & ((y.hi < at) == F.lit(left)))
            return F.array_join(F.transform(own, lambda y: y.digest), "")

        return F.struct(side(True).alias("before"), side(False).alias("after"))

    # An array of one element, so that the siblings are worked out once.
    own = F.flatten(F.transform(F.array(others), lambda found: F.transform(levels, lambda level: of_level(found, level))))
    return F.struct(x.alias("base"), F.concat(own, F.col("proof")).alias("proof"))


def _nodes(bands, fan):
    """All nodes of all bands, the last node of each group included."""
    last = F.struct(
        _height(fan).alias("level"), _long(0).alias("lo"), (F.col("n") - 1).alias("hi"), F.col("top").alias("digest")
    )
    found = [
        b.select("g", F.explode("nodes").alias("x")).select("g", F.struct("x.level", "x.lo", "x.hi", "x.digest").alias("node"))
        for b in bands
    ]
    return reduce(DataFrame.unionByName, [*found, _last_parts(bands, fan).select("g", last.alias("node"))])
