"""Reading the lake: Parquet under ``year=Y/week=W``."""

import re

from pyspark.sql import functions as F

from labflow.functions.partition import KEY, with_prefixes
from labflow.schema import LAKE
from labflow.sources.storage import Folder, subfolders

PARTITION_NAMES = [re.compile(rf"{name}=\d+") for name in KEY]


def partition_folders(spark, root):
    """Folders of the partitions the lake has, by ``(year, week)``; files and other folders are passed over."""
    found = subfolders(Folder(spark, root), PARTITION_NAMES)
    return {tuple(int(n.split("=")[1]) for n in names): str(folder) for names, folder in found}


def read_lake(spark, root, columns=None, partitions=None, prefixes=None):
    """Lake rows with ``year`` and ``week``.

    Only folders named as partitions are read, at most one per calendar week; what else lies in the root is passed over.
    ``partitions`` (a list of pairs) restricts the scan to those folders, so that a large lake is not even listed;
    ``prefixes`` (starts of partition paths) become partition filters, and ``columns`` the read schema.
    """
    # Reports and the like may lie in the same folder.
    reader = spark.read.schema(LAKE).option("pathGlobFilter", "*.parquet")
    folders = partition_folders(spark, root)
    wanted = sorted(folders) if partitions is None else [p for p in sorted(set(partitions)) if p in folders]
    rows = reader.option("basePath", root).parquet(*[folders[p] for p in wanted]) if wanted else None
    if rows is None:
        rows = spark.createDataFrame([], LAKE)
    if prefixes is not None:
        rows = with_prefixes(rows, prefixes)
    return rows if columns is None else rows.select(*columns, *KEY)


def ordered_history(lake):
    """Lake rows with the order columns of a merge, for a lake that may hold duplicates.

    Such lakes are written sorted, by merges and deletions alike (see ``in_old_order``), so all files of a partition
    come from one write whose parts are numbered in row order: the part's number, as a number, and the position in it
    give back that order.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1)
    return lake.select(
        "*",
        F.lit("").alias("source_file"),
        F.struct(
            F.concat(F.lpad(part, 12, "0"), F.lit(" "), F.col("_metadata.file_name")).alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("row_pos"),
    )


def in_old_order(ordered, *columns):
    """Rows of ``ordered_history`` sorted so that writing them keeps the order of every partition."""
    return ordered.orderBy(*KEY, "row_pos").select(*columns, *KEY)


def partition_rows(lake):
    """Rows per partition; on a plain lake scan no column is read, only row counts from file footers."""
    return lake.groupBy(*KEY).agg(F.count(F.lit(1)).alias("row_count"))
