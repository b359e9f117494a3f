"""CSV sinks. A feed file is written as a folder of parts, which the readers take for one file."""

from pyspark.sql import functions as F

from labflow.functions.text import join_details
from labflow.operators.report import report
from labflow.schema import FIELDS


def _csv(df, path, by=()):
    writer = df.write.mode("overwrite").partitionBy(*by).option("header", "true").option("escape", '"')
    # With partitions only the written ones are replaced.
    (writer.option("partitionOverwriteMode", "dynamic") if by else writer).csv(path)


def quarantine_columns(rows, extra_columns):
    """Quarantined rows with every extra column of the feed as a column of its own."""
    extras = [F.col("extra")[n].alias(n) for n in extra_columns]
    return rows.select(*FIELDS, *extras, "pipeline_error", "source_file")


def write_quarantine(rows, path, extra_columns=()):
    _csv(quarantine_columns(rows, extra_columns), path)


def write_feed(rows, root, order=("row_pos",)):
    """Feed rows as one folder per ``source_file``, parts and rows in order; a folder of the same name is replaced.

    Rows are range-partitioned by file and position, so a file that holds most rows is split over many tasks.
    """
    ordered = rows.repartitionByRange("source_file", *order).sortWithinPartitions("source_file", *order)
    _csv(ordered.drop(*order), root, by=["source_file"])


def write_requests(requests, path):
    _csv(requests.select("sample_id", "test_date"), path)


def write_report(lake, path, single_file=False):
    """The sorted report. Parts are in order; ``single_file`` pulls it through one task and is meant for small lakes."""
    rows = report(lake)
    _csv(rows.coalesce(1) if single_file else rows, path)


def write_log_history(log, path):
    """Run history with details as joined text, newest run first."""
    if "details" in log.columns:
        log = log.withColumn("processing_details", join_details(F.col("details"))).drop("details")
    _csv(log.orderBy(F.desc("execution_timestamp")), path)


def written_report_facts(spark, path):
    """Bytes, size as shown, time and number of parts of a written report."""
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return parts.select("path", "length", "modificationTime").agg(
        F.sum("length").alias("length"),
        F.count(F.lit(1)).alias("parts"),
        F.round(F.sum("length") / F.lit(1024 * 1024), 2).alias("size_mb"),
        F.date_format(F.max("modificationTime"), "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
    )
