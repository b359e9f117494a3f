"""Deletion: request files -> accepted keys -> touched partitions without the matches -> audit row -> ledger."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from labflow.functions.lines import file_unreadable, request_file_read
from labflow.functions.partition import KEY, touched_partitions
from labflow.operators.delete import (
    accepted_requests,
    checked_requests,
    counts_of_hits,
    delete_lines,
    delete_partitioned,
    deleted_rows,
    request_files,
    request_keys,
)
from labflow.operators.upsert import COLUMNS
from labflow.plans.ingest import (
    FILE_LINES,
    PARTITION_LINES,
    UNIQUE,
    close,
    lines_of,
    log_line,
    new_run_id,
    partition_key_text,
    pending_files,
    write_audit,
)
from labflow.schema import COUNTERS
from labflow.session import run_scratch, written
from labflow.sinks.commit import append_log, begin, replace_partitions
from labflow.sources.feeds import read_deletion_requests
from labflow.sources.lake import in_old_order, ordered_history, partition_rows, read_lake
from labflow.sources.storage import Folder


def delete(spark, zones, retire_inputs=True, now=None):
    """Apply the pending deletion requests; returns the counters of the run.

    Files that are unreadable, lack a column, hold a row longer than their header or a malformed date are refused as a
    whole and stay where they are. The ids of the requested partitions are read once, which gives the removed rows and,
    with the row counts in file footers, what remains; only partitions that lose rows are read again and replaced. A lake
    that may hold duplicates is rewritten in its old order, as that says which one is last.
    """
    with run_scratch(spark):
        return _delete(spark, zones, retire_inputs, now or datetime.now(timezone.utc))


def _delete(spark, zones, retire_inputs, now):
    todo = pending_files(spark, zones, "requests")
    run_id = new_run_id(now)
    begin(spark, zones, run_id, "requests" if retire_inputs else None)

    def finish(counters, lines, read):
        write_audit(spark, zones, "deletion", run_id, now, counters, lines)
        close(spark, zones, "requests", run_id, now, read, retire_inputs)
        return {c: int(counters.get(c, 0)) for c in COUNTERS["deletion"]}

    if todo.isEmpty():
        return finish({}, log_line(spark, 0, "no deletion requests"), todo)

    feed = read_deletion_requests(spark, zones.requests, todo)
    checked = written(spark, checked_requests(feed.rows), "requests")
    files = written(spark, request_files(checked), "request-files")
    number = feed.all_files.count()
    counters = {"files_processed": number}
    lines = (
        log_line(spark, 0, f"{number} deletion request files")
        .unionByName(lines_of(files, FILE_LINES, F.col("source_file"), request_file_read()))
        .unionByName(lines_of(feed.unreadable_files, FILE_LINES, F.col("source_file"), file_unreadable()))
    )
    read = todo.join(files.filter("accepted"), "source_file", "left_semi")
    if read.isEmpty():
        return finish(counters, lines.unionByName(log_line(spark, 5, "no accepted deletion requests")), read)

    requests = accepted_requests(checked, files)
    asked_ids = requests.agg(F.count_distinct("sample_id")).first()[0]
    keys = written(spark, request_keys(requests), "keys")
    partitions = [tuple(r) for r in touched_partitions(keys).collect()]  # one row per calendar week

    lake = read_lake(spark, zones.lake, partitions=partitions)
    hits = written(spark, deleted_rows(lake, keys), "hits")
    counts = written(spark, counts_of_hits(keys, partition_rows(lake), hits), "delete-counts")
    changed = counts.filter("rows_deleted > 0").collect()  # one row per calendar week, see MAX_PARTITIONS
    ids = hits.distinct()
    if changed:
        emptied = [(r.year, r.week) for r in changed if r.rows_remaining == 0]
        affected = read_lake(spark, zones.lake, partitions=[(r.year, r.week) for r in changed])
        append_log(ids.withColumn("run_id", F.lit(run_id)), f"{zones.logs}/deleted_ids", now)
        if Folder(spark, f"{zones.lake}/{UNIQUE}").exists():
            rows = delete_partitioned(affected, keys).select(*COLUMNS, *KEY).hint("rebalance", *KEY)
        else:
            rows = in_old_order(delete_partitioned(ordered_history(affected), keys), *COLUMNS)
        replace_partitions(rows, zones.lake, emptied)

    deleted = sum(r.rows_deleted for r in changed)
    counters.update(rows_deleted=deleted, partitions_updated=len(changed))
    lines = (
        lines.unionByName(log_line(spark, 2, f"{asked_ids} different samples requested"))
        .unionByName(log_line(spark, 3, f"{len(partitions)} partitions requested"))
        .unionByName(lines_of(delete_lines(ids, counts), PARTITION_LINES, partition_key_text(), F.col("line")))
        .unionByName(log_line(spark, 5, f"{deleted} rows removed from {len(changed)} partitions"))
    )
    return finish(counters, lines, read)
