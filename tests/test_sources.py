"""Feeds, lake scans, logs and listings on real files."""

from datetime import date

from pyspark.sql import functions as F

from conftest import rows
from labflow.functions.partition import KEY, in_partitions, with_partition
from labflow.operators.validate import valid_rows, validate
from labflow.sinks.files import write_feed, write_log_history
from labflow.sources import feeds
from labflow.sources.lake import partition_rows, read_lake
from labflow.sources.synthetic import synthetic_feed

HEAD = "sample_id,test_date,result,viral_load\n"


def test_columns_bind_by_name_not_by_position(spark, zones, put):
    put("landing", "a.csv", HEAD + "a,2025-12-01,POS,1\n")
    put("landing", "b.csv", "viral_load,result,sample_id,test_date,site\n2,N/A,b,2025-12-01,lab 7\n")
    put("landing", "c.csv", "sample_id,test_date,result\nc,2025-12-01,NEG\n")
    feed = feeds.read_landing(spark, zones.landing)
    assert rows(valid_rows(validate(feed.rows)), "sample_id", "test_date", "result", "viral_load") == [
        ("a", "2025-12-01", "POS", 1),
        ("b", "2025-12-01", "N/A", 2),
    ]
    assert feed.files == ["a.csv", "b.csv", "c.csv"] and feed.extra_columns == ["site"]
    assert rows(feed.rows.select("sample_id", F.col("extra")["site"].alias("site")), "sample_id", "site")[1] == ("b", "lab 7")
    bad = validate(feed.rows).filter("not ok").first()
    assert [(e.field, e.type) for e in bad.errors] == [("viral_load", "missing")]


def test_odd_files_and_names(spark, zones, put):
    put("landing", "zero.csv", "")
    put("landing", "head only.csv", HEAD)
    put("landing", "c[1]+%.csv", "﻿" + HEAD + 'c,2025-12-01,"N/A",1\n"q""x, y",2025-12-01,POS,\n')
    put("landing", "notes.txt", "not a feed")
    feed = feeds.read_landing(spark, zones.landing)
    assert feed.files == ["c[1]+%.csv", "head only.csv", "zero.csv"]
    assert feed.unreadable == ["zero.csv"]
    assert rows(feed.rows, "sample_id", "result", "viral_load", "source_file") == [
        ('q"x, y', "POS", None, "c[1]+%.csv"),
        ("c", "N/A", "1", "c[1]+%.csv"),
    ] or rows(feed.rows, "sample_id", "result", "viral_load", "source_file") == [
        ("c", "N/A", "1", "c[1]+%.csv"),
        ('q"x, y', "POS", None, "c[1]+%.csv"),
    ]
    listing = feeds.shown_files(feeds.list_files(spark, zones.landing))
    shown = ["c[1]+%.csv", "head only.csv", "notes.txt", "zero.csv"]
    assert rows(listing, "source_file") == [(name,) for name in shown]
    assert {r.source_file: r.length for r in listing.collect()}["zero.csv"] == 0
    assert feeds.read_landing(spark, zones.landing + "/none").rows.count() == 0


def test_repeated_and_differently_cased_columns(spark, zones, put):
    put("landing", "a.csv", "sample_id,Sample_ID,sample_id,test_date,result,viral_load\nx,y,z,2025-12-01,POS,1\n")
    row = feeds.read_landing(spark, zones.landing).rows.first()
    assert row.sample_id == "x" and row.extra == {"Sample_ID": "y", "sample_id_duplicated_0": "z"}


def test_long_rows_are_marked_and_short_ones_are_not(spark, zones, put):
    put("landing", "a.csv", HEAD + 'a,2025-12-01,POS,1,extra\nb,2025-12-01,POS\nc,2025-12-01,"POS,",2\n')
    got = rows(feeds.read_landing(spark, zones.landing).rows, "sample_id", "ragged")
    assert got == [("a", True), ("b", False), ("c", False)]


def test_row_order_survives_splits(spark, zones):
    n = 40_000
    feed = spark.range(n).select(
        F.concat(F.lit("s"), "id").alias("sample_id"),
        F.lit("2025-12-01").alias("test_date"),
        F.lit("POS").alias("result"),
        F.col("id").cast("string").alias("viral_load"),
        F.lit("one.csv").alias("source_file"),
        F.col("id").alias("row_pos"),
    )
    write_feed(feed, zones.landing)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        read = feeds.read_landing(spark, zones.landing).rows
        assert read.rdd.getNumPartitions() > 5
        got = [int(r.viral_load) for r in read.orderBy("source_file", "row_pos").select("viral_load").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(range(n))
    assert feeds.read_landing(spark, zones.landing).files == ["one.csv"]


def test_lake_scan_prunes_and_counts_from_footers(spark, zones, records):
    data = with_partition(records([(f"s{w}", f"2025-{w:02d}-01", "POS", w, "h", w) for w in range(1, 13)]))
    data.select("sample_id", "test_date", "result", "viral_load", *KEY).write.partitionBy(*KEY).parquet(zones.lake)
    one = read_lake(spark, zones.lake, columns=["sample_id"], partitions=[(2025, 1)])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "ReadSchema: struct<sample_id:string>" in plan
    assert rows(one, "sample_id") == [("s1",)]
    counted = partition_rows(read_lake(spark, zones.lake))
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.count() == 12
    early = read_lake(spark, zones.lake, prefixes=["year=2025/week=1/"])
    assert early.count() == 1
    assert "StartsWith" in early._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert in_partitions(read_lake(spark, zones.lake), [(2025, 1), (1999, 1)]).count() == 1
    assert read_lake(spark, zones.lake + "/none").count() == 0


def test_csv_logs(spark, zones, put):
    head = "execution_timestamp,files_processed,rows_quarantined,rows_inserted,rows_updated,processing_details\n"
    put("logs", "execution_1.csv", head + '2025-12-01T08:00:00.123456,2,1,5,0,"one | two, three"\n')
    put("logs", "execution_2.csv", head + "2025-12-02T08:00:00,0,0,0,0,\n")
    put("logs", "execution_3.csv", "")
    put("logs", "deletion_1.csv", "execution_timestamp,files_processed,rows_deleted,partitions_updated,processing_details\n2025-12-03T08:00:00,1,4,2,x\n")
    log = feeds.read_logs(spark, zones.logs)
    assert rows(log, "files_processed", "processing_details") == [(0, None), (2, "one | two, three")]
    assert rows(feeds.read_logs(spark, zones.logs, "deletion"), "rows_deleted", "partitions_updated") == [(4, 2)]
    write_log_history(log, zones.reports + "/execution_all.csv")
    assert feeds.read_logs(spark, zones.reports).count() == 2


def test_synthetic_feed(spark):
    feed = synthetic_feed(spark, "2025-12-01", weeks=4, per_week=2500, seed=3)
    assert feed.groupBy("source_file").count().count() == 4
    first = feed.orderBy("row_pos").first()
    assert first.sample_id == "TEST-49-0" and first.test_date == "2025-12-01"
    assert first.source_file == "Lab_Results_2025-12-01.csv"
    assert rows(feed.groupBy("test_date").count(), "test_date", "count")[0] == ("2025-11-10", 2500)
    share = {r.result: r["count"] / 10_000 for r in feed.groupBy("result").count().collect()}
    assert abs(share["NEG"] - 0.4) < 0.03 and abs(share["Positive"] - 0.2) < 0.03 and len(share) == 4
    loads = feed.agg(F.min(F.col("viral_load").cast("int")), F.max(F.col("viral_load").cast("int"))).first()
    assert loads[0] >= 0 and loads[1] <= 5000
    assert date.fromisoformat(first.test_date).isocalendar()[1] == 49
    again = synthetic_feed(spark, "2025-12-01", weeks=4, per_week=2500, seed=3)
    assert feed.exceptAll(again).count() == 0


def test_a_listing_takes_as_many_calls_for_many_files(spark, zones, put):
    """Empty files are listed without a call for each."""
    client = spark._jvm._gateway_client
    real, calls = client.send_command, []

    def counted(command, *args, **options):
        calls.append(command)
        return real(command, *args, **options)

    numbers = {}
    for n in (10, 1000):
        for i in range(n):
            put("landing", f"empty_{i}.csv", "")
        put("landing", "full.csv", HEAD)
        client.send_command = counted
        try:
            calls.clear()
            listing = feeds.list_files(spark, zones.landing)
            numbers[n] = sum(not c.startswith("m\n") for c in calls)
        finally:
            client.send_command = real
        assert listing.count() == n + 1 and listing.filter("length = 0").count() == n
    # The first listing looks some classes up.
    assert numbers[1000] <= numbers[10] + 5, numbers


def test_one_scan_for_any_number_of_headers(spark, zones, put):
    scans = []
    for n in (1, 6):
        for i in range(n):
            put("landing", f"f{i}.csv", HEAD.replace("viral_load", f"viral_load,site_{i}") + f"s{i},2025-12-01,POS,1,lab\n")
        rows_ = feeds.read_landing(spark, zones.landing).rows
        scans.append(rows_._jdf.queryExecution().optimizedPlan().toString().count("parquet"))
        assert rows_.count() == n
    assert scans[0] == scans[1]


def test_line_breaks_in_quotes(spark, zones, put):
    put("landing", "a.csv", 'sample_id,note,test_date,result,viral_load\r\n"a\nb","x ""y"", z",2025-12-01,POS,1\r\n\r\nc,,2025-12-01,NEG,2')
    feed = feeds.read_landing(spark, zones.landing, multi_line=True)
    got = rows(feed.rows.select("sample_id", F.col("extra")["note"].alias("note"), "viral_load"), "sample_id", "note", "viral_load")
    assert got == [("a\nb", 'x "y", z', "1"), ("c", None, "2")]
