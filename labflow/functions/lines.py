"""The wording of log lines. Every line is a row; a line about the run as a whole is a constant number of rows."""

from pyspark.sql import functions as F

from labflow.functions.partition import partition_path


def _joined(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def file_checked(valid="valid_rows", errors="error_rows"):
    return _joined("checked ", F.col("source_file"), ": ", F.col(valid), " valid, ", F.col(errors), " rejected")


def file_unreadable():
    return _joined("unreadable: ", F.col("source_file"))


def partition_merged():
    """One line per merged partition."""
    counts = _joined(partition_path(), ": ", F.col("rows_inserted"), " inserted")
    return F.when(F.col("is_new"), _joined(counts, ", new partition")).otherwise(
        _joined(counts, ", ", F.col("rows_updated"), " updated")
    )


def request_file_read():
    return F.when(
        F.col("accepted"), _joined("accepted ", F.col("source_file"), ": ", F.col("requests"), " requests")
    ).otherwise(_joined("refused ", F.col("source_file"), ": ", F.col("reason")))


def partition_deleted():
    """One line per requested partition."""
    where = _joined(partition_path(), ": ")
    return (
        F.when(F.col("status") == "not_found", _joined(where, "not in the lake"))
        .when(F.col("status") == "no_match", _joined(where, "no requested sample"))
        .otherwise(_joined(where, F.col("rows_deleted"), " removed, ", F.col("rows_remaining"), " left"))
    )


def sample_deleted():
    """One line per removed sample."""
    return _joined(partition_path(), ": removed ", F.col("sample_id"))
