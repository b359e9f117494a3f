"""Connected components of a graph given as pairs of ids."""

from pyspark.sql import functions as F


def components(edges, scratch):
    """(node, component) for every node of ``edges`` (a, b): the smallest id reachable; loops and repeats are allowed.

    Alternating stars: a node's larger neighbours are hung below its smallest one, then its smaller ones likewise, until
    nothing moves; the number of rounds grows with the logarithm of the number of nodes. Each round is one written table
    in the shared folder, the one before is removed. The minima combine before the shuffle, and the joins are plain
    equi-joins, which Spark splits at a node with very many neighbours. Only a count and a checksum reach the driver.
    """
    pairs = edges.select(
        F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b")
    ).where("a <> b")
    table, path = scratch.table(pairs.distinct())
    before = None
    while True:
        state = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        table, new = scratch.table(_small_star(_large_star(table)))
        scratch.drop(path)
        path = new
    found = table.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())


def _large_star(edges):
    """Every larger neighbour of a node, tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where("a <> b").distinct()


def _small_star(edges):
    """Every smaller neighbour of a node, and the node, tied to the smallest neighbour; a is larger than b throughout."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()
