"""What the operators of this folder share: written tables, shipping the package, bounded caches."""

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import functions as F

from labflow.session import scratch_root

PACKAGE = "labflow_source.zip"


def ship_package(spark):
    """Send this package to the executors once per application, so that their Python workers can import it."""
    context = spark.sparkContext
    if PACKAGE in (context._python_includes or []):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), PACKAGE)
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)


class Scratch:
    """Tables written below the shared folder; ``drop`` removes one that no later step reads."""

    def __init__(self, spark, label):
        self.spark = spark
        self.root = f"{scratch_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def path(self):
        self.count += 1
        return f"{self.root}/{self.count}"

    def table(self, df, compression="snappy"):
        """Write a frame and read it back: cuts the lineage and survives the loss of executors."""
        path = self.path()
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path), path

    def clear(self):
        """Remove all tables; frames read from them can no longer be used."""
        self.drop(self.root)

    def drop(self, path):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_sample(df, key, rows):
    """At most ``rows`` rows of a frame, chosen by the hash of a column, the same ones at every run.

    A first cut by the hash leaves about four times as many over all tasks, so little goes to the task that takes the
    smallest hashes of these, however many tasks there are.
    """
    hashed = F.xxhash64(F.col(f"`{key}`"))
    step = max(1, df.count() // (4 * rows))
    return df.where(F.pmod(hashed, F.lit(step)) == 0).orderBy(hashed, F.col(f"`{key}`")).limit(rows)


def with_columns(df, columns):
    """Add columns; one of the same name (in any case) in the input gives way."""
    taken = {name.lower() for name in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


class BoundedCache(dict):
    """A worker's memory of results for short keys, of at most ``limit`` entries besides those in use."""

    def __init__(self, limit):
        super().__init__()
        self.limit = limit

    def room_for(self, new, used):
        """Before ``new`` keys come in: a full cache keeps only what is in use, which are mostly the frequent keys."""
        if len(self) + len(new) > self.limit:
            kept = {k: self[k] for k in used if k in self}
            self.clear()
            self.update(kept)


def slices(sizes, limit):
    """Ranges of consecutive rows whose sizes sum to at most ``limit`` (one row at least)."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
