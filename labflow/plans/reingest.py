"""Send corrected quarantine files back to the landing zone."""

from pyspark.sql import functions as F

from labflow.operators.quarantine import gated_rows
from labflow.operators.validate import file_gate, validate
from labflow.schema import FIELDS
from labflow.session import written
from labflow.sinks.commit import remove
from labflow.sinks.files import write_feed
from labflow.sources.feeds import SOURCE_PARTITION, entry_name, list_files, read_quarantine
from labflow.sources.storage import Folder


def discard(spark, zones, names):
    """Remove quarantine files, given as a frame of ``source_file`` or a few names, without correcting them."""
    if not hasattr(names, "join"):
        names = spark.createDataFrame([(n,) for n in names], "source_file string")
    remove(spark, zones.quarantine, _entries(spark, zones.quarantine, names))


def _entries(spark, zone, names):
    """Entries of a zone that belong to feed files of a frame."""
    root = str(Folder(spark, zone))
    own = list_files(spark, root).join(names.select("source_file").distinct(), "source_file", "left_semi")
    return own.select(entry_name(F.col("path"), root).alias("entry")).distinct()


def promote(spark, zones, rows, extra_columns=(), gate=True):
    """``promote_files`` with the names on the driver, for a look at a few files."""
    return _names(promote_files(spark, zones, rows, extra_columns, gate))


def _names(files):
    return [r.source_file for r in files.orderBy("source_file").collect()]


def promote_files(spark, zones, rows, extra_columns=(), gate=True):
    """Write feed rows to the landing zone, replacing files of the same name; returns their names as a frame.

    With the gate only files in which every row is valid pass. The technical columns do not go back.
    """
    checked = validate(rows).drop("errors")
    if "ragged" in rows.columns:
        # A row longer than its header makes its file invalid.
        checked = checked.withColumn("ok", F.col("ok") & ~F.coalesce("ragged", F.lit(False)))
    validated = written(spark, checked, "corrected")
    verdicts = written(spark, file_gate(validated), "verdicts")
    if gate:
        validated = gated_rows(validated, verdicts)
        verdicts = verdicts.filter("passed")
    names = verdicts.select("source_file")
    if names.isEmpty():
        return names
    # Found before the new files of those names are there, which replace folders of the same name.
    replaced = _entries(spark, zones.landing, names).filter(~F.col("entry").startswith(SOURCE_PARTITION))
    replaced = written(spark, replaced, "replaced")
    extras = [F.col("extra")[n].alias(n) for n in extra_columns]
    write_feed(validated.select(*FIELDS, *extras, "source_file", "row_pos"), zones.landing)
    remove(spark, zones.landing, replaced)
    return names


def reingest(spark, zones, fixed=None, gate=True):
    """``reingest_files`` with the names on the driver, for a look at a few files."""
    return _names(reingest_files(spark, zones, fixed, gate))


def reingest_files(spark, zones, fixed=None, gate=True):
    """Promote corrected files and retire their quarantine files; returns their names as a frame.

    ``fixed`` is the folder of corrected files; without it the quarantine itself is read. ``gate=False`` promotes all
    files unchecked.
    """
    feed = read_quarantine(spark, fixed or zones.quarantine)
    names = written(spark, promote_files(spark, zones, feed.rows, feed.extra_columns, gate), "promoted")
    for zone in {zones.quarantine, fixed or zones.quarantine}:
        remove(spark, zone, _entries(spark, zone, names))
    return names
