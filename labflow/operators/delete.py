"""Deletion by request: semi and anti joins on ``(year, week, sample_id)``, and what they removed.

A request names a sample and a date; it removes the sample's rows of that date's week, not of that exact date. No side
is hinted: Spark broadcasts the request keys while their size is under its threshold and otherwise runs a sort-merge
join, which AQE splits on skewed keys.
"""

from pyspark.sql import functions as F

from labflow.functions.parsing import strict_date
from labflow.functions.lines import partition_deleted, sample_deleted
from labflow.functions.partition import KEY, touched_partitions, with_partition

REQUEST_FIELDS = ["sample_id", "test_date"]
ROW_KEY = [*KEY, "sample_id"]


def checked_requests(feed):
    """Request rows with the parsed date and the reason a row spoils its file.

    A row with more fields than its header spoils it too: nothing is deleted on the strength of a malformed file.
    """
    if "missing" in feed.columns:
        lacks_column = F.coalesce(F.size("missing") > 0, F.lit(False))
    else:
        lacks_column = F.lit(not set(REQUEST_FIELDS) <= set(feed.columns))
    for field in REQUEST_FIELDS:
        if field not in feed.columns:
            feed = feed.withColumn(field, F.lit(None).cast("string"))
    ragged = F.coalesce(F.col("ragged"), F.lit(False)) if "ragged" in feed.columns else F.lit(False)
    parsed = feed.withColumn("request_date", strict_date(F.col("test_date")))
    bad_date = F.col("test_date").isNotNull() & F.col("request_date").isNull()
    return parsed.withColumn(
        "reason",
        F.when(lacks_column, "Missing required columns")
        .when(ragged, "Row longer than its header")
        .when(bad_date, "Invalid test_date"),
    )


def request_files(checked):
    """Verdict and number of requests per file; one spoiled row rejects the whole file."""
    return checked.groupBy("source_file").agg(
        F.bool_and(F.col("reason").isNull()).alias("accepted"),
        F.max("reason").alias("reason"),
        F.count(F.lit(1)).alias("requests"),
    )


def accepted_requests(checked, files):
    """Typed requests of the accepted files; ``files`` is the result of ``request_files``."""
    rejected = files.filter(~F.col("accepted")).select("source_file")
    return checked.join(rejected, "source_file", "left_anti").select(
        "sample_id", F.col("request_date").alias("test_date"), "source_file"
    )


def distinct_requests(requests):
    """Number of different ids asked for, in one row."""
    return requests.agg(F.count_distinct("sample_id").alias("ids"))


def request_keys(requests):
    """Distinct ``(year, week, sample_id)`` to remove; requests without a date match nothing."""
    return with_partition(requests).filter("year is not null").select(*ROW_KEY).distinct()


def delete_partitioned(lake, keys):
    """The lake without the requested samples. ``lake`` carries ``year`` and ``week``."""
    return lake.join(keys, ROW_KEY, "left_anti")


def delete_by_id(table, requests):
    """The table without the requested ids, whatever their dates."""
    return table.join(requests.select("sample_id").distinct(), "sample_id", "left_anti")


def tag_deleted(lake, keys):
    """Lake rows with ``deleted``; the keys are distinct, so no row multiplies."""
    marked = keys.withColumn("_hit", F.lit(True))
    return lake.join(marked, ROW_KEY, "left").withColumn("deleted", F.col("_hit").isNotNull()).drop("_hit")


def deleted_ids(lake, keys):
    """Every removed id of every partition, one row each."""
    return lake.select(*ROW_KEY).join(keys, ROW_KEY, "left_semi").distinct()


def delete_counts(lake, keys):
    """Rows deleted and remaining per requested partition, with its status.

    ``not_found`` marks requested partitions the lake lacks and ``no_match`` those where nothing was removed. The
    partition list is broadcast: it has one pair per calendar week (see ``MAX_PARTITIONS``).
    """
    asked = touched_partitions(keys)
    inside = lake.select(*ROW_KEY).join(F.broadcast(asked), KEY, "left_semi")
    found = (
        tag_deleted(inside, keys)
        .groupBy(*KEY)
        .agg(
            F.count_if("deleted").alias("rows_deleted"),
            F.count_if(~F.col("deleted")).alias("rows_remaining"),
        )
    )
    return _with_status(asked, found)


def _with_status(asked, found):
    status = (
        F.when(F.col("found").isNull(), "not_found").when(F.col("rows_deleted") == 0, "no_match").otherwise("deleted")
    )
    return asked.join(found.withColumn("found", F.lit(True)), KEY, "left").select(
        *KEY,
        F.coalesce("rows_deleted", F.lit(0)).alias("rows_deleted"),
        F.coalesce("rows_remaining", F.lit(0)).alias("rows_remaining"),
        status.alias("status"),
    )


def deleted_rows(lake, keys):
    """The key of every row to remove, one row each."""
    return lake.select(*ROW_KEY).join(keys, ROW_KEY, "left_semi")


def counts_of_hits(keys, totals, hits):
    """``delete_counts`` from rows already found: ``totals`` has the ``row_count`` of partitions, ``hits`` the removed rows."""
    removed = hits.groupBy(*KEY).agg(F.count(F.lit(1)).alias("removed"))
    found = totals.join(removed, KEY, "left").select(
        *KEY,
        F.coalesce("removed", F.lit(0)).alias("rows_deleted"),
        (F.col("row_count") - F.coalesce("removed", F.lit(0))).alias("rows_remaining"),
    )
    return _with_status(touched_partitions(keys), found)


def delete_misses(counts):
    """Requested partitions without data or without a match."""
    return counts.filter("status <> 'deleted'").select(*KEY, "status")


def delete_totals(counts):
    return counts.agg(
        F.coalesce(F.sum("rows_deleted"), F.lit(0)).alias("rows_deleted"),
        F.count_if(F.col("rows_deleted") > 0).alias("partitions_updated"),
    )


def delete_lines(ids, counts):
    """Log lines of a deletion: one per requested partition and one per removed sample, however many there are."""
    described = counts.select(*KEY, partition_deleted().alias("line"))
    return described.unionByName(ids.select(*KEY, sample_deleted().alias("line")))
