"""What a run leaves behind: replaced partitions, log tables, and the ledger that acknowledges its inputs.

Spark replaces the partitions of the lake (dynamic partition overwrite). A run acknowledges its inputs last, so a run that
broke off anywhere is made up for by the next one, which meets the same files again: replacing partitions by a merge
gives the same rows twice, and what the broken run had put into quarantine is found by its mark and removed. One run at a
time may work on the same zones.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import functions as F

from labflow.functions.partition import KEY
from labflow.schema import LISTING
from labflow.session import written
from labflow.sources.feeds import entry_name, list_files
from labflow.sources.storage import Folder, has_files

# Folder of marks of runs that have started and not ended.
STARTED = "_started"
LEDGER = f"{LISTING}, run_id string"
# A month of a log table is rewritten as one file when it has more files than this.
MOST_FILES = 24
# Entries deleted at the same time, and looked at together.
DELETERS, ENTRIES = 16, 1000


@dataclass
class Zones:
    """Roots of the zones; they may lie on different file systems."""

    landing: str
    quarantine: str
    lake: str
    logs: str
    requests: str
    reports: str
    ledger: str

    @classmethod
    def below(cls, root):
        return cls(**{name: f"{root}/{name}" for name in cls.__dataclass_fields__})


def replace_partitions(rows, root, emptied=()):
    """Whole new content of lake partitions. ``rows`` may be read from the partitions they replace.

    Rows that are sorted by partition and something else keep that order in the parts' numbers. ``emptied`` lists
    partitions that lose their last row, at most one per calendar week: an overwrite leaves those alone.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEY).parquet(root)
    for year, week in emptied:
        Folder(rows.sparkSession, f"{root}/year={year}/week={week}").delete()


def append_log(rows, path, now):
    """Add rows to a log table, kept by month so that many runs leave few files."""
    month = f"{now:%Y-%m}"
    writer = rows.withColumn("month", F.lit(month)).coalesce(1).write.partitionBy("month")
    writer.mode("append").parquet(path)
    folder = Folder(rows.sparkSession, f"{path}/month={month}")
    if sum(not n.startswith(("_", ".")) for n in folder.names()) > MOST_FILES:
        spark = rows.sparkSession
        held = spark.read.schema(rows.schema).parquet(str(folder)).withColumn("month", F.lit(month))
        # Read from a copy, as the month itself is what is replaced.
        copy = written(spark, held, "log")
        copy.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def quarantine_path(zones, run_id):
    return f"{zones.quarantine}/quarantine_{run_id}.csv"


def begin(spark, zones, run_id, zone=None):
    """Mark a run as started, after tidying up behind runs that broke off; there is one mark for each of these.

    What a run without a line in the ledger left in quarantine goes, as its files are read again. A run that is in the
    ledger and meant to delete its inputs (``zone`` names where) has that done for it.
    """
    marks = Folder(spark, f"{zones.ledger}/{STARTED}")
    for mark in marks.names():
        broken, _, of_zone = mark.partition(".")
        if read_ledger(spark, zones).filter(F.col("run_id") == broken).isEmpty():
            Folder(spark, quarantine_path(zones, broken)).delete()
        elif of_zone:
            retire(spark, zones, of_zone, broken)
        marks.child(mark).delete()
    marks.child(f"{run_id}.{zone}" if zone else run_id).mark()


def end(spark, zones, run_id):
    marks = Folder(spark, f"{zones.ledger}/{STARTED}")
    for mark in marks.names():
        if mark.partition(".")[0] == run_id:
            marks.child(mark).delete()


def acknowledge(files, zones, run_id, now):
    """Record input files (path, length, modificationTime) as consumed."""
    rows = files.select("path", "length", "modificationTime", F.lit(run_id).alias("run_id"))
    append_log(rows, zones.ledger, now)


def read_ledger(spark, zones):
    """Input files earlier runs consumed."""
    if not has_files(spark, zones.ledger):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(zones.ledger)


def consumed(listing, ledger):
    """Listed files that a run consumed already; a file uploaded again under its name is not the same file."""
    return listing.join(ledger, ["path", "length", "modificationTime"], "left_semi")


def pending(listing, ledger):
    """Listed files no run has consumed, empty files included."""
    return listing.join(ledger, ["path", "length", "modificationTime"], "left_anti")


def retire(spark, zones, zone, run_id):
    """Delete what a run consumed in a zone: whole entries, a folder of many parts by one call.

    An entry with a file that no run has consumed stays. The ledger makes this optional: consumed files are not read
    again.
    """
    root = str(Folder(spark, getattr(zones, zone)))
    identity = ["path", "length", "modificationTime"]
    done = read_ledger(spark, zones).groupBy(*identity).agg(F.bool_or(F.col("run_id") == run_id).alias("own"))
    marked = list_files(spark, root).join(done, identity, "left")
    entries = marked.groupBy(entry_name(F.col("path"), root).alias("entry")).agg(
        F.bool_and(F.col("own").isNotNull()).alias("whole"), F.bool_or("own").alias("own")
    )
    remove(spark, root, entries.filter("whole AND own").select("entry"))


def remove(spark, root, entries):
    """Delete entries (frame of ``entry``) of a folder."""
    folder, names = Folder(spark, root), (r.entry for r in entries.toLocalIterator())
    with ThreadPoolExecutor(DELETERS) as pool:
        while some := list(islice(names, ENTRIES)):
            list(pool.map(lambda name: folder.child(name).delete(), some))
