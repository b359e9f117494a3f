"""Every operator applied to the given tables.

Each query takes a session and the folder of the tables. Feeds are derived from whole tables (see ``orders_feed``);
history and batch are its even and odd rows. Queries on sources, sinks and jobs write to the scratch folder first.
"""

from datetime import datetime

from pyspark.sql import functions as F

from labflow.functions.lines import file_checked
from labflow.functions.partition import (
    KEY,
    one_partition,
    partition_path,
    partition_total,
    touched_partitions,
    with_partition,
)
from labflow.functions.text import date_text, join_details, render_errors, split_details
from labflow.operators import audit, delete, quarantine, report, upsert, validate
from labflow.plans.deletion import delete as delete_job
from labflow.plans.export import export
from labflow.plans.ingest import ingest
from labflow.plans.orders_feed import deletion_requests, lax_feed, orders_feed
from labflow.plans.reingest import promote_files
from labflow.schema import FIELDS
from labflow.session import new_scratch, written
from labflow.sinks.commit import Zones, append_log
from labflow.sinks.files import write_feed, write_log_history, write_quarantine, write_report, write_requests
from labflow.sources import feeds, lake
from labflow.sources.storage import Folder
from labflow.streaming.incremental import ingest_new_files

RECORD = ["sample_id", "test_date", "result", "viral_load"]


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _feed(spark, sf):
    return orders_feed(_table(spark, sf, "orders"))


def _checked(spark, sf):
    return validate.validate(_feed(spark, sf))


def _valid(spark, sf):
    return validate.valid_rows(_checked(spark, sf), keep=["source_file", "row_pos"])


def _history_and_batch(spark, sf, rows="true"):
    """Valid even and odd rows of the feed; split before the check, so no row is checked twice."""
    feed = _feed(spark, sf).filter(rows)
    parts = [feed.filter(f"row_pos % 2 = {rest}") for rest in (0, 1)]
    return [validate.valid_rows(validate.validate(p), keep=["source_file", "row_pos"]) for p in parts]


def _lake(spark, sf):
    return upsert.upsert_partitioned(*_history_and_batch(spark, sf))


def _by_customer(feed):
    """The same rows as many small files, so that whole files can be valid."""
    return feed.withColumn("source_file", F.concat(F.lit("Lab_"), "sample_id", F.lit(".csv")))


def _quarantine(spark, sf):
    return validate.invalid_rows(_checked(spark, sf))


# -- validation ---------------------------------------------------------------------------------------------------


def validate_route(spark, sf):
    return _checked(spark, sf).select("row_pos", "ok", "valid_date", "valid_load")


def validate_lax(spark, sf):
    rows = validate.validate(lax_feed(_table(spark, sf, "orders")))
    kinds = F.array_join(F.transform("errors", lambda e: F.concat(e["field"], F.lit(":"), e["type"])), ",")
    return rows.select("row_pos", "ok", "valid_date", "valid_load", kinds.alias("error_types"))


def validate_columns(spark, sf):
    """A feed that lacks a contract column and has one column too many."""
    feed = _feed(spark, sf).withColumnRenamed("viral_load", "load")
    rows = validate.validate(feed)
    return rows.select("row_pos", "ok", "load", render_errors(F.col("errors")).alias("pipeline_error"))


def valid_records(spark, sf):
    return _valid(spark, sf).select(*RECORD, date_text(F.col("test_date")).alias("date_text"), "row_pos")


def quarantine_rows(spark, sf):
    return _quarantine(spark, sf).select(*FIELDS, "pipeline_error", "source_file", "row_pos")


def drop_technical(spark, sf):
    return quarantine.drop_technical(_quarantine(spark, sf)).drop("errors")


def file_counts(spark, sf):
    return validate.file_counts(_checked(spark, sf))


def file_gate(spark, sf):
    return validate.file_gate(validate.validate(_by_customer(_feed(spark, sf))))


def gated_rows(spark, sf):
    checked = validate.validate(_by_customer(_feed(spark, sf)))
    rows = quarantine.gated_rows(checked, validate.file_gate(checked))
    return rows.select(*FIELDS, "source_file", "row_pos")


# -- partitions ---------------------------------------------------------------------------------------------------


def partition_keys(spark, sf):
    return with_partition(_valid(spark, sf)).select("row_pos", *KEY, partition_path().alias("partition_path"))


def touched(spark, sf):
    return touched_partitions(with_partition(_valid(spark, sf)))


def touched_total(spark, sf):
    return partition_total(with_partition(_valid(spark, sf)))


def single_partition(spark, sf):
    return one_partition(with_partition(_valid(spark, sf)), 1997, 1).select(*RECORD, "row_pos")


# -- upsert -------------------------------------------------------------------------------------------------------


def union_batch(spark, sf):
    return upsert.union_batch(*_history_and_batch(spark, sf)).select(*RECORD, "is_batch", "row_pos")


def upsert_partitioned(spark, sf):
    return _lake(spark, sf)


def _even_weeks_and_rest(spark, sf):
    """History: even rows of even weeks; batch: all other rows, so that odd weeks are new partitions."""
    rows = with_partition(_valid(spark, sf))
    past = (F.col("row_pos") % 2 == 0) & (F.col("week") % 2 == 0)
    return [rows.filter(side).drop(*KEY) for side in (past, ~past)]


def upsert_append(spark, sf):
    """New partitions keep their duplicates."""
    return upsert.upsert_partitioned(*_even_weeks_and_rest(spark, sf), new_partition="append")


def upsert_global(spark, sf):
    return upsert.upsert_global(*_history_and_batch(spark, sf))


def upsert_counts(spark, sf):
    return upsert.upsert_counts(*_history_and_batch(spark, sf))


def upsert_append_counts(spark, sf):
    return upsert.upsert_counts(*_even_weeks_and_rest(spark, sf), new_partition="append")


def upsert_totals(spark, sf):
    return upsert.upsert_totals(upsert.upsert_counts(*_history_and_batch(spark, sf)))


def global_counts(spark, sf):
    return upsert.global_counts(*_history_and_batch(spark, sf))


# -- deletion -----------------------------------------------------------------------------------------------------


def _request_feed(spark, sf):
    """Request rows as text: one file per nation, a few of them spoiled by a date in another form."""
    typed = deletion_requests(_table(spark, sf, "customer"), _valid(spark, sf), files=25)
    spoiled = F.col("source_file").isin([f"Requests_{n}.csv" for n in (3, 10, 17, 24)])
    other_form = F.when(spoiled & (F.dayofmonth("test_date") < 15), F.date_format("test_date", "MM/dd/yyyy"))
    return typed.withColumn("test_date", F.coalesce(other_form, date_text(F.col("test_date"))))


def _keys(spark, sf):
    return delete.request_keys(deletion_requests(_table(spark, sf, "customer"), _valid(spark, sf)))


def request_files(spark, sf):
    return delete.request_files(delete.checked_requests(_request_feed(spark, sf)))


def accepted_requests(spark, sf):
    checked = delete.checked_requests(_request_feed(spark, sf))
    return delete.accepted_requests(checked, delete.request_files(checked))


def distinct_requests(spark, sf):
    return delete.distinct_requests(deletion_requests(_table(spark, sf, "customer"), _valid(spark, sf)))


def delete_partitioned(spark, sf):
    return delete.delete_partitioned(_lake(spark, sf), _keys(spark, sf)).select(*RECORD, *KEY)


def delete_by_id(spark, sf):
    requests = deletion_requests(_table(spark, sf, "customer"), _valid(spark, sf))
    return delete.delete_by_id(_lake(spark, sf), requests).select(*RECORD, *KEY)


def deleted_ids(spark, sf):
    return delete.deleted_ids(_lake(spark, sf), _keys(spark, sf))


def delete_counts(spark, sf):
    return delete.delete_counts(_lake(spark, sf), _keys(spark, sf))


def delete_misses(spark, sf):
    return delete.delete_misses(delete.delete_counts(_lake(spark, sf), _keys(spark, sf)))


def delete_totals(spark, sf):
    return delete.delete_totals(delete.delete_counts(_lake(spark, sf), _keys(spark, sf)))


def delete_lines(spark, sf):
    """Lines of partitions and of samples, one row each."""
    stored, keys = _lake(spark, sf), _keys(spark, sf)
    return delete.delete_lines(delete.deleted_ids(stored, keys), delete.delete_counts(stored, keys))


# -- report and quarantine ----------------------------------------------------------------------------------------


def report_rows(spark, sf):
    return report.report(_lake(spark, sf))


def preview(spark, sf):
    return report.preview(_lake(spark, sf).select(*RECORD), 1_000, [F.desc("test_date"), "sample_id", "viral_load"])


def feed_preview(spark, sf):
    return report.preview(_feed(spark, sf), order=["row_pos"])


def report_facts(spark, sf):
    return report.report_facts(_lake(spark, sf))


def written_report_facts(spark, sf):
    """Rows of an exported report, the bytes of its rows (each part also has a header), and that its time is known."""
    zones = Zones.below(new_scratch(spark, "zones"))
    _lake(spark, sf).hint("rebalance", *KEY).write.partitionBy(*KEY).parquet(zones.lake)
    facts = export(spark, zones)
    header = len(",".join(RECORD)) + 1
    names = ["row_count", "length", "size_mb", "parts", "last_modified"]
    row = spark.createDataFrame([[facts[n] for n in names]], "row_count long, length long, size_mb double, parts long, last_modified string")
    return row.select(
        "row_count",
        (F.col("length") - header * F.col("parts")).alias("row_bytes"),
        (F.col("size_mb") == F.round(F.col("length") / F.lit(1024 * 1024), 2)).alias("size_is_shown"),
        F.to_timestamp("last_modified").isNotNull().alias("time_is_known"),
    )


def distinct_errors(spark, sf):
    return quarantine.distinct_errors(_quarantine(spark, sf))


def error_counts(spark, sf):
    return quarantine.error_counts(_quarantine(spark, sf))


def pending_files(spark, sf):
    rows = validate.invalid_rows(validate.validate(_by_customer(_feed(spark, sf))))
    staged = quarantine.file_names(rows.filter("row_pos % 3 = 0"))
    return quarantine.pending_files(quarantine.file_names(rows), staged)


def rows_per_file(spark, sf):
    return quarantine.rows_per_file(_quarantine(spark, sf))


def apply_corrections(spark, sf):
    """Typos corrected, some cells twice and some emptied, rows without a load removed, one row added per nation."""
    rows = quarantine.drop_technical(_quarantine(spark, sf).withColumn("file", F.col("source_file")))
    rows = rows.withColumnRenamed("file", "source_file").drop("errors")
    rows = rows.withColumn("extra", F.create_map(F.lit("site"), F.lit("old"), F.lit("row"), F.col("row_pos").cast("string")))

    def edit(condition, field, value, number):
        cell = [F.lit(field).alias("field"), F.lit(value).cast("string").alias("value"), F.lit(number).alias("edit_no")]
        return rows.filter(condition).select("source_file", "row_pos", *cell)

    edits = (
        edit("result = 'Positive'", "result", "NEG", 1)
        .unionByName(edit("result = 'Positive'", "result", "POS", 2))
        .unionByName(edit("test_date = '12/01/2025'", "test_date", "2025-12-01", 1))
        .unionByName(edit("viral_load = 'x'", "viral_load", None, 1))
        .unionByName(edit("result = 'Positive'", "site", "new", 1))
    )
    removals = rows.filter("viral_load is null").select("source_file", "row_pos")
    additions = _table(spark, sf, "nation").select(
        F.concat(F.lit("N-"), "n_nationkey").alias("sample_id"),
        F.lit("2025-12-01").alias("test_date"),
        F.lit("NEG").alias("result"),
        F.lit("0").alias("viral_load"),
        F.lit("Lab_Results_0.csv").alias("source_file"),
        (-1 - F.col("n_nationkey")).cast("bigint").alias("row_pos"),
    )
    corrected = quarantine.apply_corrections(rows, edits, removals, additions)
    return corrected.select("*", F.col("extra")["site"].alias("site"), F.col("extra")["row"].alias("row")).drop("extra")


# -- audit log ----------------------------------------------------------------------------------------------------


def _log(spark, sf):
    """One run per order day, with a line per file; runs without failing rows carry no details."""
    checked = validate.validate(orders_feed(_table(spark, sf, "orders"), keep=["o_orderdate"]))
    run = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("execution_timestamp")
    per_file = checked.groupBy(run, "source_file").agg(
        F.count_if("ok").alias("valid_rows"), F.count_if(~F.col("ok")).alias("error_rows")
    )
    lines = per_file.select("execution_timestamp", F.col("source_file").alias("line_order"), file_checked().alias("line"))
    counters = per_file.groupBy("execution_timestamp").agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.sum("error_rows").alias("rows_quarantined"),
        F.sum("valid_rows").alias("rows_inserted"),
        F.sum(F.lit(0)).cast("bigint").alias("rows_updated"),
    )
    runs = audit.run_rows(lines, counters, ["execution_timestamp"])
    text = F.when(F.col("rows_quarantined") > 0, join_details(F.col("details"))).otherwise("")
    return runs.withColumn("processing_details", text).drop("details")


def log_history(spark, sf):
    return audit.history(_log(spark, sf))


def log_latest(spark, sf):
    return audit.latest_run(_log(spark, sf))


def log_with_details(spark, sf):
    return audit.runs_with_details(_log(spark, sf))


def log_labels(spark, sf):
    labelled = audit.labelled_runs(_log(spark, sf))
    return labelled.select("execution_timestamp", "shown_timestamp", "run_label")


def log_details(spark, sf):
    return audit.detail_lines(_log(spark, sf))


def log_metrics(spark, sf):
    return audit.metrics_only(_log(spark, sf))


# -- sources, sinks and jobs --------------------------------------------------------------------------------------


def landing_scan(spark, sf):
    """Files with the same columns in three orders, one with a column more and one with a column less."""
    root = new_scratch(spark, "landing")
    feed = _feed(spark, sf)
    layouts = [
        ["sample_id", "test_date", "result", "viral_load"],
        ["viral_load", "result", "test_date", "sample_id"],
        ["result", "sample_id", "viral_load", "test_date", "site"],
        ["test_date", "sample_id", "viral_load"],
    ]
    for i, columns in enumerate(layouts):
        part = feed.filter(F.pmod("row_pos", F.lit(len(layouts))) == i).withColumns(
            {"site": F.concat(F.lit("site "), "row_pos"), "source_file": F.lit(f"layout_{i}.csv")}
        )
        write_feed(part.select(*columns, "source_file", "row_pos"), root)
    rows = feeds.read_landing(spark, root).rows
    return rows.select(
        *FIELDS, F.array_join("missing", ",").alias("missing"), F.col("extra")["site"].alias("site"), "source_file"
    )


def file_listing(spark, sf):
    """Feed files, one without content and one of another kind; sizes of files that are not parts of a feed."""
    root = new_scratch(spark, "landing")
    write_feed(_feed(spark, sf), root)
    Folder(spark, f"{root}/empty.csv").mark()
    names = _table(spark, sf, "nation").orderBy("n_nationkey").select(F.col("n_name").alias("value"))
    names.coalesce(1).write.text(f"{root}/names.txt")
    shown = feeds.shown_files(feeds.list_files(spark, root))
    whole = F.when(~F.col("source_file").startswith("Lab_"), F.col("length"))
    return shown.select("source_file", whole.alias("length"), (F.col("length") > 0).alias("filled"))


def quarantine_scan(spark, sf):
    root = new_scratch(spark, "quarantine")
    rows = _quarantine(spark, sf).withColumn("extra", F.lit(None).cast("map<string,string>"))
    write_quarantine(rows, f"{root}/quarantine_1.csv")
    return feeds.read_quarantine(spark, root).rows.select(*FIELDS, "pipeline_error")


def request_scan(spark, sf):
    """Requests with ids of digits only, which keep their leading zeros."""
    root = new_scratch(spark, "requests")
    padded = _valid(spark, sf).select(F.regexp_replace("sample_id", "S-", "000").alias("sample_id"), "test_date")
    write_requests(padded, f"{root}/deletion_request_1.csv")
    checked = delete.checked_requests(feeds.read_deletion_requests(spark, root).rows)
    return delete.accepted_requests(checked, delete.request_files(checked))


def log_scan(spark, sf):
    root = new_scratch(spark, "logs")
    write_log_history(_log(spark, sf), f"{root}/execution_1.csv")
    return audit.metrics_only(feeds.read_logs(spark, root))


def run_history(spark, sf):
    """One history: runs of even days come from CSV logs, those of odd days from the log table."""
    root = new_scratch(spark, "logs")
    log = written(spark, _log(spark, sf), "log")
    odd = F.dayofmonth(F.to_timestamp("execution_timestamp")) % 2 == 1
    write_log_history(log.filter(~odd), f"{root}/execution_1.csv")
    lines = F.when(F.col("processing_details") != "", split_details(F.col("processing_details")))
    runs = log.filter(odd).withColumns({"details": lines, "execution_timestamp": F.to_timestamp("execution_timestamp")})
    append_log(runs.drop("processing_details"), f"{root}/execution", datetime(2025, 12, 1))
    found = audit.history(feeds.read_all_runs(spark, root))
    return found.select(
        F.date_format("execution_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("execution_timestamp"),
        "files_processed",
        "rows_quarantined",
        "rows_inserted",
        "rows_updated",
        F.size(F.coalesce("details", F.array().cast("array<string>"))).alias("detail_lines"),
        F.coalesce(join_details(F.col("details")), F.lit("")).alias("processing_details"),
    )


def _written_lake(spark, sf):
    root = new_scratch(spark, "lake")
    _lake(spark, sf).hint("rebalance", *KEY).write.partitionBy(*KEY).parquet(root)
    return root


def lake_scan(spark, sf):
    """One column of two partitions; both restrictions reach the scan."""
    rows = lake.read_lake(spark, _written_lake(spark, sf), columns=["sample_id"], partitions=[(1996, 1), (1997, 52)])
    return rows.select("sample_id", *KEY)


def lake_prefix_scan(spark, sf):
    rows = lake.read_lake(spark, _written_lake(spark, sf), prefixes=["year=1996/week=1", "year=1998/"])
    return rows.select(*RECORD, *KEY)


def _two_runs(spark, sf):
    """Zones after the even and then the odd rows of the feed were ingested."""
    zones = Zones.below(new_scratch(spark, "zones"))
    for rest in (0, 1):
        write_feed(_feed(spark, sf).filter(f"row_pos % 2 = {rest}"), zones.landing)
        ingest(spark, zones)
    return zones


def ingest_job(spark, sf):
    return lake.read_lake(spark, _two_runs(spark, sf).lake)


def ingest_log(spark, sf):
    runs = feeds.read_runs(spark, _two_runs(spark, sf).logs)
    return runs.select("files_processed", "rows_quarantined", "rows_inserted", "rows_updated")


def stream_job(spark, sf):
    zones = Zones.below(new_scratch(spark, "zones"))
    checkpoint = new_scratch(spark, "stream")
    for rest in (0, 1):
        write_feed(_feed(spark, sf).filter(f"row_pos % 2 = {rest}"), zones.landing)
        ingest_new_files(spark, zones, checkpoint)
    return lake.read_lake(spark, zones.lake)


def _deletion(spark, sf):
    zones = Zones.below(new_scratch(spark, "zones"))
    _lake(spark, sf).hint("rebalance", *KEY).write.partitionBy(*KEY).parquet(zones.lake)
    requests = deletion_requests(_table(spark, sf, "customer"), _valid(spark, sf))
    write_requests(requests, f"{zones.requests}/deletion_request_1.csv")
    delete_job(spark, zones)
    return zones


def deletion_job(spark, sf):
    return lake.read_lake(spark, _deletion(spark, sf).lake)


def deletion_log(spark, sf):
    runs = feeds.read_runs(spark, _deletion(spark, sf).logs, "deletion")
    return runs.select("files_processed", "rows_deleted", "partitions_updated")


def _rejects(spark, sf):
    """Zones after a deletion with one good request file and three malformed ones."""
    zones = Zones.below(new_scratch(spark, "zones"))
    stored = written(spark, _lake(spark, sf), "lake")
    stored.hint("rebalance", *KEY).write.partitionBy(*KEY).parquet(zones.lake)
    number = F.substring("sample_id", 3, 20).cast("bigint")
    asked = stored.select("sample_id", date_text(F.col("test_date")).alias("test_date"))
    write_requests(asked.filter(number % 4 == 0), f"{zones.requests}/good.csv")
    write_requests(asked.filter(number % 4 == 2).withColumn("test_date", F.lit("12/01/2025")), f"{zones.requests}/date.csv")
    asked.filter(number % 4 == 3).select("sample_id").write.option("header", "true").csv(f"{zones.requests}/column.csv")
    # Another quote character leaves a comma in the open: a field too many for every reader.
    long = asked.filter(number % 4 == 1).withColumn("test_date", F.concat("test_date", F.lit(",more")))
    long.write.option("header", "true").option("quote", "|").csv(f"{zones.requests}/long.csv")
    delete_job(spark, zones)
    return zones


def deletion_rejects(spark, sf):
    """What remains in the lake."""
    return lake.read_lake(spark, _rejects(spark, sf).lake)


def deletion_files_kept(spark, sf):
    """Refused files stay, with the reasons in the lines of the run."""
    zones = _rejects(spark, sf)
    lines = feeds.read_run_lines(spark, zones.logs, "deletion").filter("line like 'refused %'")
    left = feeds.list_files(spark, zones.requests).select("source_file").distinct()
    return left.join(lines, F.col("line").contains(F.col("source_file")), "left").select("source_file", "line")


def ingest_append_job(spark, sf):
    """Even rows appended with their duplicates, requests applied, then odd rows merged: the last one counts."""
    zones = Zones.below(new_scratch(spark, "zones"))
    write_feed(_feed(spark, sf).filter("row_pos % 2 = 0"), zones.landing)
    ingest(spark, zones, new_partition="append")
    requests = deletion_requests(_table(spark, sf, "customer"), _valid(spark, sf))
    write_requests(requests, f"{zones.requests}/deletion_request_1.csv")
    delete_job(spark, zones)
    write_feed(_feed(spark, sf).filter("row_pos % 2 = 1"), zones.landing)
    ingest(spark, zones)
    return lake.read_lake(spark, zones.lake)


def lake_with_report(spark, sf):
    """A lake whose folder also holds its report and a folder of something else."""
    zones = Zones.below(new_scratch(spark, "zones"))
    write_feed(_feed(spark, sf).filter("row_pos % 2 = 0"), zones.landing)
    ingest(spark, zones)
    write_report(lake.read_lake(spark, zones.lake), f"{zones.lake}/final.csv")
    _table(spark, sf, "nation").write.parquet(f"{zones.lake}/year=old/week=none")
    write_feed(_feed(spark, sf).filter("row_pos % 2 = 1"), zones.landing)
    ingest(spark, zones)
    return lake.read_lake(spark, zones.lake)


def audit_lines(spark, sf):
    """Lines about files and partitions of two runs."""
    lines = feeds.read_run_lines(spark, _two_runs(spark, sf).logs)
    return lines.filter("line_order.section in (1, 4)").select(F.col("line_order.section").alias("section"), "line")


def export_job(spark, sf):
    zones = Zones.below(new_scratch(spark, "zones"))
    _lake(spark, sf).hint("rebalance", *KEY).write.partitionBy(*KEY).parquet(zones.lake)
    export(spark, zones)
    schema = "sample_id string, test_date date, result string, viral_load bigint"
    return spark.read.schema(schema).option("header", "true").csv(f"{zones.reports}/report.csv")


def reingest_job(spark, sf):
    """Codes and loads are corrected, dates are not: files go back to the landing zone as far as every row is valid."""
    zones = Zones.below(new_scratch(spark, "zones"))
    held = _feed(spark, sf).withColumns(
        {
            "extra": F.lit(None).cast("map<string,string>"),
            "source_file": F.concat(F.lit("Lab_"), F.col("row_pos") % 82, F.lit(".csv")),
        }
    )
    def edit(condition, field, value):
        cell = [F.lit(field).alias("field"), F.lit(value).alias("value"), F.lit(1).alias("edit_no")]
        return held.filter(condition).select("source_file", "row_pos", *cell)

    edits = edit("result = 'Positive'", "result", "POS").unionByName(
        edit("coalesce(viral_load, 'x') = 'x'", "viral_load", "0")
    )
    promote_files(spark, zones, quarantine.apply_corrections(held, edits))
    return feeds.read_landing(spark, zones.landing).rows.select(*FIELDS, "source_file")


QUERIES = {
    f.__name__: f
    for f in [
        validate_route,
        validate_lax,
        validate_columns,
        valid_records,
        quarantine_rows,
        drop_technical,
        file_counts,
        file_gate,
        gated_rows,
        partition_keys,
        touched,
        touched_total,
        single_partition,
        union_batch,
        upsert_partitioned,
        upsert_append,
        upsert_global,
        upsert_counts,
        upsert_append_counts,
        upsert_totals,
        global_counts,
        request_files,
        accepted_requests,
        distinct_requests,
        delete_partitioned,
        delete_by_id,
        deleted_ids,
        delete_counts,
        delete_misses,
        delete_totals,
        delete_lines,
        report_rows,
        preview,
        feed_preview,
        report_facts,
        written_report_facts,
        distinct_errors,
        error_counts,
        pending_files,
        rows_per_file,
        apply_corrections,
        log_history,
        log_latest,
        log_with_details,
        log_labels,
        log_details,
        log_metrics,
        landing_scan,
        file_listing,
        quarantine_scan,
        request_scan,
        log_scan,
        run_history,
        lake_scan,
        lake_prefix_scan,
        ingest_job,
        ingest_log,
        stream_job,
        deletion_job,
        deletion_log,
        deletion_rejects,
        deletion_files_kept,
        ingest_append_job,
        lake_with_report,
        audit_lines,
        export_job,
        reingest_job,
    ]
}
