"""Ingest: landing CSVs -> validate -> quarantine and lake -> log tables -> ledger."""

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Observation
from pyspark.sql import functions as F

from labflow.functions.lines import file_checked, file_unreadable, partition_merged
from labflow.functions.partition import KEY, with_partition
from labflow.operators.audit import run_rows
from labflow.operators.upsert import COLUMNS, ORDER, keep_last, kept_history, upsert_counts, upsert_partitioned
from labflow.operators.validate import invalid_rows, validate
from labflow.schema import COUNTERS
from labflow.session import new_scratch, run_scratch, written
from labflow.sinks.commit import (
    acknowledge,
    append_log,
    begin,
    end,
    pending,
    quarantine_path,
    read_ledger,
    replace_partitions,
    retire,
)
from labflow.sinks.files import write_quarantine
from labflow.sources.feeds import list_files, read_landing
from labflow.sources.lake import ordered_history, partition_folders, partition_rows, read_lake
from labflow.sources.storage import Folder

# Sections of a run's lines that grow with its files and partitions.
FILE_LINES, PARTITION_LINES = 1, 4
# Present in a lake whose partitions hold every sample once. Such a history is merged without being shuffled.
UNIQUE = "_unique"


def pending_files(spark, zones, zone, pattern="*.csv"):
    """Files of a zone no run has consumed, empty files included, as a written listing."""
    listing = list_files(spark, getattr(zones, zone), pattern)
    return written(spark, pending(listing, read_ledger(spark, zones)), "pending")


def new_run_id(now):
    return f"{now:%Y%m%d_%H%M%S}_{uuid4().hex[:8]}"


def log_line(spark, section, line):
    """One line of a run as a frame, to be united with lines computed by executors."""
    return spark.createDataFrame([((section, ""), line)], "line_order struct<section:int,key:string>, line string")


def lines_of(df, section, key, line):
    order = F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"))
    return df.select(order.alias("line_order"), line.alias("line"))


def partition_key_text():
    return F.format_string("%05d%02d", "year", "week")


def write_audit(spark, zones, kind, run_id, now, counters, lines):
    """Add the run row, with the lines about the run as a whole, and all lines to their log tables.

    Lines about files, partitions and samples are rows of the table of lines only, however many or few there are.
    """
    names = COUNTERS[kind]
    lines = written(spark, lines.withColumn("run_id", F.lit(run_id)), "run-lines")
    whole = lines.filter(~F.col("line_order.section").isin(FILE_LINES, PARTITION_LINES))
    row = (now.replace(tzinfo=None), *[int(counters.get(c, 0)) for c in names], run_id)
    schema = ", ".join(["execution_timestamp timestamp", *[f"{c} bigint" for c in names], "run_id string"])
    rows = run_rows(whole, spark.createDataFrame([row], schema), ["run_id"])
    append_log(lines, f"{zones.logs}/{kind}_lines", now)
    append_log(rows.select("execution_timestamp", *names, "details", "run_id"), f"{zones.logs}/{kind}", now)


def _write_validated(spark, feed):
    """The checked feed as a table, and its totals, observed while it is written.

    The CSVs are parsed once and no later step depends on a lost executor. Valid rows keep their typed values only,
    failing rows their text. A file with a row longer than its header is unreadable as a whole; ``ragged`` counts such rows.
    """
    path = new_scratch(spark, "validated")
    bad = ~F.col("ok")
    checked = validate(feed.rows)
    slim = checked.withColumns({c: F.when(bad, F.col(c)) for c in ("test_date", "viral_load", "extra", "errors")})
    seen = Observation("validated")
    slim.observe(
        seen, F.count_if("ok").alias("valid"), F.count_if(bad).alias("bad"), F.count_if("ragged").alias("ragged")
    ).write.mode("overwrite").partitionBy("ok").parquet(path)
    totals = seen.get
    return spark.read.schema(checked.schema).parquet(path), totals


def _merge(spark, zones, valid, new_partition):
    """Replace the touched partitions of the lake; returns counts per partition as a small table."""
    marker = Folder(spark, f"{zones.lake}/{UNIQUE}")
    held = set(partition_folders(spark, zones.lake))
    lake_is_new = not held
    unique = new_partition == "dedup" and (lake_is_new or marker.exists())
    batch = with_partition(valid)

    if unique:
        last = written(spark, keep_last(batch, [*KEY, "sample_id"], ORDER).select(*COLUMNS, *KEY), "batch")
        touched = last.groupBy(*KEY).agg(F.count(F.lit(1)).alias("ids")).collect()  # one row per calendar week
        weeks = [(r.year, r.week) for r in touched]
        history = read_lake(spark, zones.lake, partitions=held.intersection(weeks))
        known = {(r.year, r.week): r.row_count for r in partition_rows(history).collect()}
        # Spark sends the keys to every task while they are under its threshold; the history is then not shuffled here.
        kept = kept_history(history, last.select(*KEY, "sample_id"))
        if lake_is_new:
            marker.mark()
        replace_partitions(kept.unionByName(last).hint("rebalance", *KEY), zones.lake)
        after = {(r.year, r.week): r.row_count for r in partition_rows(read_lake(spark, zones.lake, partitions=weeks)).collect()}
        counts = []
        for r in touched:
            at = (r.year, r.week)
            inserted = after[at] - known.get(at, 0)
            counts.append((*at, inserted, r.ids - inserted, at not in known))
    else:
        # Read by the order and the counts, and unharmed by what is replaced below.
        batch = written(spark, batch, "batch")
        valid = batch.drop(*KEY)
        present = held.intersection(tuple(r) for r in batch.select(*KEY).distinct().collect())
        history = read_lake(spark, zones.lake, partitions=present)
        counts = [tuple(r) for r in upsert_counts(history, valid, new_partition).collect()]
        ordered = ordered_history(history) if present else history
        merged = upsert_partitioned(ordered, valid, new_partition=new_partition, keep=ORDER)
        if new_partition == "append":
            # What a later merge takes for row order.
            rows = merged.orderBy(*KEY, *ORDER).select(*COLUMNS, *KEY)
            marker.delete()
        else:
            rows = merged.select(*COLUMNS, *KEY).hint("rebalance", *KEY)
        replace_partitions(rows, zones.lake)
    return spark.createDataFrame(
        counts, "year int, week int, rows_inserted bigint, rows_updated bigint, is_new boolean"
    )


def ingest(spark, zones, new_partition="dedup", retire_inputs=True, files=None, now=None, multi_line=False):
    """Process the pending landing files, or the given ones; returns the counters of the run.

    ``files``, a frame like that of ``list_files``, lets a stream name what it saw; of these too only pending ones are
    read. Inputs are recorded in the ledger after everything else is in place and, with ``retire_inputs``, then deleted.
    Unreadable files stay where they are. A run that broke off before the ledger is made up for by the next.
    """
    with run_scratch(spark):
        return _ingest(spark, zones, new_partition, retire_inputs, files, now, multi_line)


def _ingest(spark, zones, new_partition, retire_inputs, files, now, multi_line):
    now = now or datetime.now(timezone.utc)
    todo = pending_files(spark, zones, "landing")
    if files is not None:
        todo = written(spark, todo.join(files.select("path").distinct(), "path", "left_semi"), "pending")
    run_id = new_run_id(now)
    begin(spark, zones, run_id, "landing" if retire_inputs else None)
    if todo.isEmpty():
        write_audit(spark, zones, "execution", run_id, now, {}, log_line(spark, 0, "no new files"))
        end(spark, zones, run_id)
        return {c: 0 for c in COUNTERS["execution"]}

    feed = read_landing(spark, zones.landing, todo, multi_line)
    checked, totals = _write_validated(spark, feed)
    per_file = checked.groupBy("source_file").agg(
        F.count_if("ok").alias("valid_rows"),
        F.count_if(~F.col("ok")).alias("error_rows"),
        F.bool_or("ragged").alias("ragged"),
    )
    failed = feed.unreadable_files.withColumn("readable", F.lit(False))
    if totals["ragged"]:
        per_file = written(spark, per_file, "files")
        dropped = per_file.filter("ragged").select("source_file")
        checked = checked.join(dropped, "source_file", "left_anti")
        failed = failed.unionByName(dropped.withColumn("readable", F.lit(False))).distinct()
        per_file = per_file.filter("not ragged")
        left = per_file.agg(F.sum("valid_rows").alias("valid"), F.sum("error_rows").alias("bad")).first()
        totals = {"valid": left.valid or 0, "bad": left.bad or 0}
    files = feed.all_files.join(failed, "source_file", "left").join(per_file, "source_file", "left")
    files = written(spark, files.fillna(0, ["valid_rows", "error_rows"]).fillna(True, ["readable"]), "files")

    number = files.count()
    line = F.when(F.col("readable"), file_checked()).otherwise(file_unreadable())
    lines = log_line(spark, 0, f"{number} files in the landing zone").unionByName(
        lines_of(files, FILE_LINES, F.col("source_file"), line)
    )
    if totals["bad"]:
        write_quarantine(invalid_rows(checked), quarantine_path(zones, run_id), feed.extra_columns)
        lines = lines.unionByName(log_line(spark, 2, f"{totals['bad']} rows to quarantine_{run_id}.csv"))

    counters = {"files_processed": number, "rows_quarantined": totals["bad"]}
    if totals["valid"]:
        valid = checked.filter("ok").select(
            "sample_id", F.col("valid_date").alias("test_date"), "result", F.col("valid_load").alias("viral_load"), *ORDER
        )
        counts = _merge(spark, zones, valid, new_partition)
        summed = counts.agg(
            F.sum("rows_inserted").alias("ins"), F.sum("rows_updated").alias("upd"), F.count(F.lit(1)).alias("n")
        ).first()
        counters.update(rows_inserted=summed.ins, rows_updated=summed.upd)
        lines = lines.unionByName(
            log_line(spark, 3, f"{totals['valid']} valid records in {summed.n} partitions")
        ).unionByName(lines_of(counts, PARTITION_LINES, partition_key_text(), partition_merged()))
    else:
        lines = lines.unionByName(log_line(spark, 3, "no valid records"))

    write_audit(spark, zones, "execution", run_id, now, counters, lines)
    close(spark, zones, "landing", run_id, now, todo.join(files.filter("readable"), "source_file", "left_semi"), retire_inputs)
    return {c: int(counters.get(c, 0)) for c in COUNTERS["execution"]}


def close(spark, zones, zone, run_id, now, read, retire_inputs):
    """Acknowledge the files that were read and, if asked to, delete them."""
    acknowledge(read, zones, run_id, now)
    if retire_inputs:
        retire(spark, zones, zone, run_id)
    end(spark, zones, run_id)
