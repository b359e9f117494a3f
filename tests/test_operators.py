"""Merge, deletion, quarantine, report and audit operators on small fixtures."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows
from labflow.functions.partition import in_partitions, one_partition, partition_path, with_partition, with_prefixes
from labflow.operators import audit, delete, quarantine, report, upsert
from labflow.schema import FIELDS

H, B = "history.csv", "batch.csv"


def test_partition_pairs_calendar_year_with_iso_week(records):
    got = with_partition(
        records([("a", "2024-12-30", "POS", 1, H, 1), ("b", "2027-01-01", "POS", 1, H, 2), ("c", "2024-01-02", "POS", 1, H, 3)])
    ).select("sample_id", partition_path().alias("path"))
    assert rows(got, "sample_id", "path") == [
        ("a", "year=2024/week=1"),
        ("b", "year=2027/week=53"),
        ("c", "year=2024/week=1"),
    ]


def test_partition_filters(records):
    df = with_partition(
        records([("a", "2025-01-06", "POS", 1, H, 1), ("b", "2025-03-10", "POS", 1, H, 2), ("c", "2026-01-06", "POS", 1, H, 3)])
    )
    assert rows(in_partitions(df, [(2025, 2), (2026, 2)]), "sample_id") == [("a",), ("c",)]
    assert rows(in_partitions(df, [(2025, 2), (2025, 11), (2026, 11)]), "sample_id") == [("a",), ("b",)]
    assert in_partitions(df, []).count() == 0
    assert rows(one_partition(df, 2025, 11), "sample_id") == [("b",)]
    # A prefix is text: "week=1" also covers week 11, and with the slash it does not.
    assert rows(with_prefixes(df, ["year=2025/week=1"]), "sample_id") == [("b",)]
    assert with_prefixes(df, ["year=2025/week=1/"]).count() == 0
    assert with_prefixes(df, [""]).count() == 3


def test_last_is_batch_then_file_then_row(records):
    history = records([("a", "2025-12-01", "NEG", 1, "z.csv", 99), ("b", "2025-12-01", "NEG", 1, H, 1)])
    batch = records(
        [
            ("a", "2025-12-02", "POS", 2, "b.csv", 1),
            ("a", "2025-12-03", "N/A", 3, "a.csv", 50),
            ("a", "2025-12-04", "POS", 4, "b.csv", 2),
        ]
    )
    for order in (batch, batch.orderBy(F.desc("row_pos")), batch.repartition(3)):
        got = upsert.upsert_partitioned(history, order)
        assert rows(got, "sample_id", "viral_load") == [("a", 4), ("b", 1)]


def test_sample_in_two_weeks_exists_twice(records):
    history = records([("a", "2025-12-01", "NEG", 1, H, 1)])
    batch = records([("a", "2025-12-15", "POS", 2, B, 1)])
    assert upsert.upsert_partitioned(history, batch).count() == 2
    assert rows(upsert.upsert_global(history, batch), "sample_id", "viral_load") == [("a", 2)]
    counts = upsert.global_counts(history, batch).first()
    assert tuple(counts) == (0, 1, 1, 1)


def test_new_partition_append_keeps_duplicates(records):
    history = records([("a", "2025-12-01", "NEG", 1, H, 1)])
    batch = records(
        [
            ("a", "2025-12-02", "POS", 2, B, 1),
            ("x", "2025-12-15", "POS", 3, B, 2),
            ("x", "2025-12-15", "NEG", 4, B, 3),
        ]
    )
    got = upsert.upsert_partitioned(history, batch, new_partition="append")
    assert rows(got, "sample_id", "viral_load") == [("a", 2), ("x", 3), ("x", 4)]
    counts = rows(upsert.upsert_counts(history, batch, "append"), "week", "rows_inserted", "rows_updated", "is_new")
    assert counts == [(49, 0, 1, False), (51, 2, 0, True)]
    counts = rows(upsert.upsert_counts(history, batch), "week", "rows_inserted", "rows_updated", "is_new")
    assert counts == [(49, 0, 1, False), (51, 1, 0, True)]
    with pytest.raises(ValueError):
        upsert.upsert_partitioned(history, batch, new_partition="other")


def test_equal_values_still_count_as_update(records):
    same = [("a", "2025-12-01", "NEG", 1, H, 1)]
    assert tuple(upsert.upsert_totals(upsert.upsert_counts(records(same), records(same))).first()) == (0, 1, 1)


def test_hot_key_is_reduced_before_the_exchange(spark):
    """One sample holds a third of all rows."""
    n = 30_000
    batch = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), "id")).alias("sample_id"),
        F.lit(date(2025, 12, 1)).alias("test_date"),
        F.lit("POS").alias("result"),
        F.col("id").alias("viral_load"),
        F.lit(B).alias("source_file"),
        F.col("id").alias("row_pos"),
    )
    merged = upsert.upsert_partitioned(batch.limit(0), batch)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert merged.filter("sample_id = 'hot'").first().viral_load == n - 3
    assert merged.count() == n - n // 3 + 1


def requests(spark, pairs):
    return spark.createDataFrame(
        [(s, d, f) for s, d, f in pairs], "sample_id string, test_date string, source_file string"
    )


def test_one_bad_date_rejects_a_request_file(spark):
    checked = delete.checked_requests(
        requests(spark, [("001", "2025-12-01", "a"), ("2", "12/01/2025", "b"), ("3", "2025-12-01", "b"), ("4", None, "a")])
    )
    files = delete.request_files(checked)
    assert rows(files, "source_file", "accepted", "requests") == [("a", True, 2), ("b", False, 2)]
    accepted = delete.accepted_requests(checked, files)
    assert rows(accepted, "sample_id") == [("001",), ("4",)]
    assert rows(delete.request_keys(accepted), "year", "week", "sample_id") == [(2025, 49, "001")]


def test_deletion_matches_the_week_not_the_date(spark, records):
    lake = with_partition(
        records(
            [
                ("a", "2025-12-01", "POS", 1, H, 1),
                ("a", "2025-12-15", "POS", 2, H, 2),
                ("b", "2025-12-01", "POS", 3, H, 3),
                ("c", "2025-12-22", "POS", 4, H, 4),
            ]
        )
    )
    asked = requests(spark, [("a", "2025-12-05", "r"), ("x", "2025-12-15", "r"), ("c", "2025-12-22", "r"), ("a", "2020-01-01", "r")])
    asked = asked.withColumn("test_date", F.col("test_date").cast("date"))
    keys = delete.request_keys(asked)
    assert rows(delete.delete_partitioned(lake, keys), "viral_load") == [(2,), (3,)]
    assert rows(delete.delete_by_id(lake, asked), "viral_load") == [(3,)]
    assert rows(delete.deleted_ids(lake, keys), "week", "sample_id") == [(49, "a"), (52, "c")]
    counts = delete.delete_counts(lake, keys)
    assert rows(counts, "year", "week", "rows_deleted", "rows_remaining", "status") == [
        (2020, 1, 0, 0, "not_found"),
        (2025, 49, 1, 1, "deleted"),
        (2025, 51, 0, 1, "no_match"),
        (2025, 52, 1, 0, "deleted"),
    ]
    assert rows(delete.delete_misses(counts), "year", "week") == [(2020, 1), (2025, 51)]
    assert tuple(delete.delete_totals(counts).first()) == (2, 2)


def test_every_removed_id_is_a_line(spark, records):
    lake = with_partition(records([(f"s{i}", "2025-12-01", "POS", i, H, i) for i in range(5)]))
    keys = lake.select("year", "week", "sample_id")
    ids, counts = delete.deleted_ids(lake, keys), delete.delete_counts(lake, keys)
    lines = [r.line for r in delete.delete_lines(ids, counts).collect()]
    assert sum(line.endswith(tuple(f"removed s{i}" for i in range(5))) for line in lines) == 5 and len(lines) == 6
    assert ids.count() == 5


def test_corrections(spark, feed):
    held = feed(
        [
            ("a", "12/01/2025", "Positive", "1", "q.csv", 1),
            ("b", "2025-12-01", "N/A", "x", "q.csv", 2),
            ("c", "2025-12-01", "POS", None, "q.csv", 3),
        ]
    ).withColumn("pipeline_error", F.lit("some error"))
    held = held.withColumn("extra", F.create_map(F.lit("site"), F.lit("old")))
    edits = spark.createDataFrame(
        [
            ("q.csv", 1, "test_date", "2025-12-01", 1),
            ("q.csv", 1, "result", "POS", 2),
            ("q.csv", 1, "result", "NEG", 1),
            ("q.csv", 2, "viral_load", "7", 1),
            ("q.csv", 2, "result", None, 3),
            ("q.csv", 2, "site", "new", 1),
            ("q.csv", 2, "room", "9", 1),
        ],
        "source_file string, row_pos bigint, field string, value string, edit_no int",
    )
    removals = spark.createDataFrame([("q.csv", 3)], "source_file string, row_pos bigint")
    added = feed([("d", "2025-12-02", "NEG", "0", "q.csv", 4)])
    got = quarantine.apply_corrections(held, edits, removals, added)
    assert rows(got, "sample_id", "test_date", "result", "viral_load") == [
        ("a", "2025-12-01", "POS", "1"),
        ("b", "2025-12-01", None, "7"),
        ("d", "2025-12-02", "NEG", "0"),
    ]
    extras = {r.sample_id: r.extra for r in got.collect()}
    assert extras == {"a": {"site": "old"}, "b": {"site": "new", "room": "9"}, "d": None}
    assert set(quarantine.drop_technical(got).columns).isdisjoint({"pipeline_error", "source_file"})
    assert quarantine.drop_technical(held.drop("pipeline_error")).columns == [*FIELDS, "row_pos", "extra"]


def test_pending_files_and_counts(feed):
    held = feed([("a", "", "", "", "q1", 1), ("b", "", "", "", "q2", 1), ("c", "", "", "", "q2", 2)])
    names = quarantine.file_names(held)
    assert rows(quarantine.pending_files(names, names.filter("source_file = 'q1'")), "source_file") == [("q2",)]
    assert rows(quarantine.rows_per_file(held), "source_file", "row_count") == [("q1", 1), ("q2", 2)]


def test_report_is_newest_first(records):
    lake = records([("b", "2025-12-01", "POS", 1, H, 1), ("a", "2025-12-02", "POS", 2, H, 2), ("a", "2025-12-01", "NEG", 3, H, 3)])
    assert [r.viral_load for r in report.report(lake).collect()] == [2, 3, 1]
    assert [r.viral_load for r in report.preview(lake, 2, ["viral_load"]).collect()] == [1, 2]
    assert "TakeOrdered" in report.preview(lake, 2, ["viral_load"])._jdf.queryExecution().executedPlan().toString()


def test_audit_queries(spark):
    log = spark.createDataFrame(
        [
            ("2025-12-01T08:00:00.5", 2, 1, 5, 0, "one | two"),
            ("2025-12-03T08:00:00", 0, 0, 0, 0, ""),
            ("2025-12-02T09:30:00", 1, 0, 0, 3, None),
        ],
        "execution_timestamp string, files_processed int, rows_quarantined int, rows_inserted int, rows_updated int, "
        "processing_details string",
    )
    assert [r.files_processed for r in audit.history(log).collect()] == [0, 1, 2]
    assert tuple(audit.latest_run(log).first()) == ("2025-12-03T08:00:00", 0, 0, 0, 0)
    assert audit.runs_with_details(log).count() == 1
    assert rows(audit.detail_lines(log), "line_no", "line") == [(0, "one"), (1, "two")]
    assert rows(audit.labelled_runs(log).filter("files_processed = 2"), "run_label") == [("Run at 2025-12-01 08:00:00",)]
    assert audit.metrics_only(log).columns[-1] == "rows_updated"
    assert "processing_details" in audit.metrics_only(log.drop("rows_updated")).columns
    # Joined text comes apart inside a line that holds the separator; an array does not.
    kept = log.filter("files_processed = 2").withColumn("details", F.array(F.lit("deleted | ids")))
    assert rows(audit.detail_lines(kept), "line_no", "line") == [(0, "deleted | ids")]
