"""The (calendar year, ISO week) partition key of the lake."""

from functools import reduce

from pyspark.sql import functions as F

KEY = ["year", "week"]
# A date lies in one of 9,999 years and one of 53 weeks, so a list of distinct partitions has at most this many
# 8-byte pairs whatever the table holds. That bound is what allows partition lists to be broadcast.
MAX_PARTITIONS = 9_999 * 53


def with_partition(df, date="test_date"):
    """Add ``year`` and ``week``. The year is the calendar year and the week the ISO week, so 2024-12-30 falls in
    year=2024/week=1 and 2027-01-01 in year=2027/week=53."""
    return df.withColumns({"year": F.year(date), "week": F.weekofyear(date)})


def partition_path(year="year", week="week"):
    return F.concat(F.lit("year="), F.col(year), F.lit("/week="), F.col(week))


def touched_partitions(df):
    """Distinct partitions of a frame that has ``year`` and ``week``."""
    return df.select(*KEY).distinct()


def partition_total(df):
    return touched_partitions(df).agg(F.count(F.lit(1)).alias("partitions"))


def one_partition(df, year, week):
    """Rows of one partition; on a partitioned scan this is a partition filter."""
    return df.filter((F.col("year") == year) & (F.col("week") == week))


def in_partitions(df, partitions):
    """Rows of the listed ``(year, week)`` pairs as a literal predicate, so the scan prunes directories."""
    by_year = {}
    for year, week in partitions:
        by_year.setdefault(year, set()).add(week)
    if not by_year:
        return df.filter(F.lit(False))
    # Years that need the same weeks share one term; a table touched evenly stays a short predicate.
    by_weeks = {}
    for year, weeks in by_year.items():
        by_weeks.setdefault(frozenset(weeks), []).append(year)
    terms = [
        F.col("year").isin(sorted(years)) & F.col("week").isin(sorted(weeks))
        for weeks, years in sorted(by_weeks.items(), key=lambda kv: min(kv[1]))
    ]
    return df.filter(reduce(lambda a, b: a | b, terms))


def with_prefixes(df, prefixes):
    """Rows whose partition path starts with one of ``prefixes``; ``""`` keeps all."""
    path = F.concat(partition_path(), F.lit("/"))
    if "" in prefixes:
        return df
    return df.filter(reduce(lambda a, b: a | b, [path.startswith(p) for p in prefixes]))
