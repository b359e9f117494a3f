"""The full-table report and previews."""

from pyspark.sql import functions as F

from labflow.schema import RECORD


def report(lake):
    """Every row, newest date first. The id decides ties, which also lets a range sort split a crowded date."""
    return lake.select(*RECORD.fieldNames()).orderBy(F.desc("test_date"), "sample_id")


def preview(df, n=10, order=()):
    """First ``n`` rows; with an order this plans a top-n instead of a full sort."""
    return (df.orderBy(*order) if order else df).limit(n)


def report_facts(report_rows):
    """Size of the report in one row."""
    return report_rows.agg(F.count(F.lit(1)).alias("row_count"))
