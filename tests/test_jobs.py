"""Whole runs on real folders: counters, files left behind, interruption and repetition."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from labflow.operators import audit, quarantine
from labflow.plans.deletion import delete
from labflow.plans.export import export
from labflow.plans import ingest as ingest_plan
from labflow.plans.ingest import ingest, pending_files
from labflow.plans.reingest import discard, promote, reingest
from labflow.sinks import commit
from labflow.sources import feeds
from labflow.sources.lake import read_lake
from labflow.streaming.incremental import ingest_new_files

HEAD = "sample_id,test_date,result,viral_load\n"
DAY1 = HEAD + "TEST-001,2025-12-01,POS,5000\nTEST-002,2025-12-02,NEG,0\nTEST-999,2025-12-05,Positive,8000\n"


def lake(spark, zones):
    return rows(read_lake(spark, zones.lake), "sample_id", "test_date", "result", "viral_load")


def left(zones, zone):
    return sorted(n for n in os.listdir(getattr(zones, zone)) if not n.startswith((".", "_")))


def lines(spark, zones, kind="execution"):
    """All lines of the last run, in order."""
    found = feeds.read_run_lines(spark, zones.logs, kind).collect()
    last = max(r.run_id for r in found)
    return [r.line for r in sorted((r for r in found if r.run_id == last), key=lambda r: (*r.line_order, r.line))]


def counters(*values):
    return dict(zip(["files_processed", "rows_quarantined", "rows_inserted", "rows_updated"], values))


def test_land_quarantine_correct_reingest_delete_report(spark, zones, put):
    put("landing", "Lab_Results_1.csv", DAY1)
    put("landing", "zero.csv", "")
    assert ingest(spark, zones) == counters(2, 1, 2, 0)
    assert left(zones, "landing") == ["zero.csv"]
    got = lines(spark, zones)
    assert got[0] == "2 files in the landing zone"
    assert got[1:3] == ["checked Lab_Results_1.csv: 2 valid, 1 rejected", "unreadable: zero.csv"]
    assert got[3].startswith("1 rows to quarantine_")
    assert got[4:] == ["2 valid records in 1 partitions", "year=2025/week=49: 2 inserted, new partition"]

    # The uncorrected file does not pass the gate and stays.
    assert reingest(spark, zones) == [] and len(left(zones, "quarantine")) == 1
    held = feeds.read_quarantine(spark, zones.quarantine)
    assert "Invalid result code: 'Positive'" in held.rows.first().pipeline_error
    cell = [F.lit("result").alias("field"), F.lit("POS").alias("value"), F.lit(1).alias("edit_no")]
    edits = held.rows.select("source_file", "row_pos", *cell)
    names = promote(spark, zones, quarantine.apply_corrections(held.rows, edits))
    assert names == held.files
    discard(spark, zones, held.files)
    put("landing", "Lab_Results_2.csv", HEAD + "TEST-001,2025-12-03,NEG,7\n")
    assert ingest(spark, zones) == counters(3, 0, 1, 1)
    assert lake(spark, zones) == [
        ("TEST-001", "2025-12-03", "NEG", 7),
        ("TEST-002", "2025-12-02", "NEG", 0),
        ("TEST-999", "2025-12-05", "POS", 8000),
    ]

    put("requests", "r1.csv", "note,test_date,sample_id\nx,2025-12-01,TEST-002\nx,2024-01-01,TEST-001\n")
    put("requests", "r2.csv", "sample_id\nTEST-001\n")
    put("requests", "r3.csv", "sample_id,test_date\nTEST-001,2025-12-03\nTEST-999,12/05/2025\n")
    assert delete(spark, zones) == {"files_processed": 3, "rows_deleted": 1, "partitions_updated": 1}
    assert left(zones, "requests") == ["r2.csv", "r3.csv"]
    assert [s for s, *_ in lake(spark, zones)] == ["TEST-001", "TEST-999"]
    assert lines(spark, zones, "deletion") == [
        "3 deletion request files",
        "accepted r1.csv: 2 requests",
        "refused r2.csv: Missing required columns",
        "refused r3.csv: Invalid test_date",
        "2 different samples requested",
        "2 partitions requested",
        "year=2024/week=1: not in the lake",
        "year=2025/week=49: 1 removed, 2 left",
        "year=2025/week=49: removed TEST-002",
        "1 rows removed from 1 partitions",
    ]
    ids = spark.read.parquet(f"{zones.logs}/deleted_ids")
    assert rows(ids, "year", "week", "sample_id") == [(2025, 49, "TEST-002")]

    facts = export(spark, zones, single_file=True)
    assert facts["row_count"] == 2
    with open([f for f in _parts(f"{zones.reports}/report.csv")][0]) as f:
        assert f.read() == HEAD + "TEST-999,2025-12-05,POS,8000\nTEST-001,2025-12-03,NEG,7\n"
    assert read_lake(spark, zones.lake).count() == 2


def _parts(folder):
    return sorted(os.path.join(folder, n) for n in os.listdir(folder) if n.startswith("part-"))


def test_same_input_again_inserts_nothing(spark, zones, put):
    for expected in (counters(1, 1, 2, 0), counters(1, 1, 0, 2)):
        put("landing", "Lab_Results_1.csv", DAY1)
        assert ingest(spark, zones) == expected
    assert len(lake(spark, zones)) == 2
    assert len(left(zones, "quarantine")) == 2
    assert ingest(spark, zones) == counters(0, 0, 0, 0)
    assert feeds.read_runs(spark, zones.logs).count() == 3
    assert lines(spark, zones) == ["no new files"]
    # Nothing that a run wrote for itself stays behind.
    scratch = spark.conf.get("spark.checkpoint.dir") + "/labflow"
    assert not [n for n in os.listdir(scratch) if n.startswith("run-")]
    assert delete(spark, zones) == {"files_processed": 0, "rows_deleted": 0, "partitions_updated": 0}
    assert export(spark, commit.Zones.below(zones.reports)) is None


def test_consumed_files_that_were_kept_are_not_read_twice(spark, zones, put):
    put("landing", "Lab_Results_1.csv", DAY1)
    ingest(spark, zones, retire_inputs=False)
    assert left(zones, "landing") == ["Lab_Results_1.csv"] and pending_files(spark, zones, "landing").isEmpty()
    put("landing", "Lab_Results_1.csv", DAY1 + "TEST-003,2025-12-01,POS,1\n")
    assert ingest(spark, zones, retire_inputs=False) == counters(1, 1, 1, 2)


def test_deleting_the_last_row_removes_the_partition(spark, zones, put):
    put("landing", "a.csv", HEAD + "a,2025-12-01,POS,1\nb,2025-12-15,POS,2\n")
    ingest(spark, zones)
    put("requests", "r.csv", "sample_id,test_date\na,2025-12-01\n")
    assert delete(spark, zones)["rows_deleted"] == 1
    assert lake(spark, zones) == [("b", "2025-12-15", "POS", 2)]
    assert not os.path.exists(f"{zones.lake}/year=2025/week=49")


def test_a_file_with_a_long_row_is_left_alone(spark, zones, put):
    put("landing", "bad.csv", HEAD + "a,2025-12-01,POS,1\nb,2025-12-01,POS,1,2\n")
    put("landing", "good.csv", HEAD + "c,2025-12-01,POS,1\n")
    assert ingest(spark, zones) == counters(2, 0, 1, 0)
    assert left(zones, "landing") == ["bad.csv"]
    assert [s for s, *_ in lake(spark, zones)] == ["c"]
    assert "unreadable: bad.csv" in lines(spark, zones)


def test_a_malformed_request_file_deletes_nothing(spark, zones, put):
    put("landing", "a.csv", HEAD + "A,2025-01-06,POS,1\nB,2025-01-06,NEG,2\n")
    ingest(spark, zones)
    put("requests", "long.csv", "sample_id,test_date\nA,2025-01-06,junk,more\n")
    put("requests", "good.csv", "sample_id,test_date\nB,2025-01-07\n")
    assert delete(spark, zones)["rows_deleted"] == 1
    assert [s for s, *_ in lake(spark, zones)] == ["A"] and left(zones, "requests") == ["long.csv"]
    assert "refused long.csv: Row longer than its header" in lines(spark, zones, "deletion")


def test_other_files_in_the_lake_are_passed_over(spark, zones, put):
    put("landing", "a.csv", HEAD + "A,2025-01-06,POS,1\n")
    ingest(spark, zones)
    put("lake", "final.csv", "sample_id\nA\n")
    os.makedirs(f"{zones.lake}/year=2025/notes")
    put("landing", "b.csv", HEAD + "B,2025-01-06,POS,1\n")
    assert ingest(spark, zones) == counters(1, 0, 1, 0)
    assert read_lake(spark, zones.lake).count() == 2


def test_a_deletion_keeps_which_duplicate_is_last(spark, zones, put):
    many = "".join(f"x{i:05d},2025-01-06,POS,{i}\n" for i in range(3000))
    put("landing", "a.csv", HEAD + "A,2025-01-06,POS,1\n" + many + "A,2025-01-07,NEG,2\n")
    ingest(spark, zones, new_partition="append")
    put("requests", "r.csv", "sample_id,test_date\nx00007,2025-01-06\n")
    assert delete(spark, zones)["rows_deleted"] == 1
    put("landing", "b.csv", HEAD + "B,2025-01-06,POS,1\n")
    ingest(spark, zones)
    assert [r for r in lake(spark, zones) if r[0] == "A"] == [("A", "2025-01-07", "NEG", 2)]


def test_discarded_quarantine_files_go(spark, zones, put):
    put("landing", "a.csv", HEAD + "A,bad,POS,1\n")
    ingest(spark, zones)
    discard(spark, zones, left(zones, "quarantine"))
    assert feeds.list_files(spark, zones.quarantine, "*.csv").isEmpty()


@pytest.mark.parametrize("mode", ["dedup", "append"])
def test_a_batch_of_new_weeks_only(spark, zones, put, mode):
    put("landing", "a.csv", HEAD + "a,2025-12-01,POS,1\n")
    ingest(spark, zones, new_partition=mode)
    put("landing", "b.csv", HEAD + "a,2025-12-15,POS,2\n")
    assert ingest(spark, zones, new_partition=mode) == counters(1, 0, 1, 0)
    assert [v for *_, v in lake(spark, zones)] == [1, 2]


def test_run_rows_hold_lines_about_the_run_only(spark, zones, put):
    put("landing", "a.csv", DAY1)
    ingest(spark, zones)
    run = feeds.read_runs(spark, zones.logs)
    assert [line.split()[1] for line in run.first().details] == ["files", "rows", "valid"]
    assert len(lines(spark, zones)) == 5
    named = spark.read.parquet(f"{zones.logs}/execution")
    assert audit.lines_of_runs(named, feeds.read_run_lines(spark, zones.logs)).count() == 5


def test_only_bad_rows(spark, zones, put):
    put("landing", "a.csv", "sample_id,test_date,result,viral_load,site\na,,POS,1,lab 7\n")
    assert ingest(spark, zones) == counters(1, 1, 0, 0)
    assert lines(spark, zones)[-1] == "no valid records"
    held = feeds.read_quarantine(spark, zones.quarantine)
    assert held.rows.first().extra == {"site": "lab 7"}


def test_append_mode_keeps_duplicates_until_the_next_touch(spark, zones, put):
    twice = HEAD + "a,2025-12-01,POS,1\na,2025-12-02,NEG,2\nb,2025-12-01,POS,3\n"
    put("landing", "a.csv", twice)
    assert ingest(spark, zones, new_partition="append") == counters(1, 0, 3, 0)
    assert len(lake(spark, zones)) == 3
    put("landing", "b.csv", HEAD + "b,2025-12-03,N/A,4\nc,2025-12-15,N/A,5\nc,2025-12-15,N/A,6\n")
    assert ingest(spark, zones, new_partition="append") == counters(1, 0, 2, 1)
    assert lake(spark, zones) == [
        ("a", "2025-12-02", "NEG", 2),
        ("b", "2025-12-03", "N/A", 4),
        ("c", "2025-12-15", "N/A", 5),
        ("c", "2025-12-15", "N/A", 6),
    ]
    # A lake that may hold duplicates is merged by order in dedup mode as well.
    put("landing", "c.csv", HEAD + "d,2025-12-15,N/A,7\n")
    assert ingest(spark, zones) == counters(1, 0, 1, 0)
    assert [v for *_, v in lake(spark, zones)] == [2, 4, 6, 7]


class Interrupted(Exception):
    pass


@pytest.mark.parametrize(
    "at,mode",
    [
        ("write_quarantine", "dedup"),
        ("replace_partitions", "dedup"),
        ("replace_partitions", "append"),
        ("write_audit", "dedup"),
        ("acknowledge", "dedup"),
        ("retire", "dedup"),
    ],
)
def test_a_run_that_breaks_off_is_made_up_for(spark, zones, put, monkeypatch, at, mode):
    """Whichever step is the last to end, the next run leaves what an unbroken one leaves."""
    put("landing", "a.csv", HEAD + "a,2025-12-01,POS,1\nb,2025-12-15,POS,2\nc,bad,POS,2\n")
    ingest(spark, zones, new_partition=mode)
    put("landing", "b.csv", HEAD + "a,2025-12-02,NEG,9\nd,2025-12-15,POS,4\ne,bad,POS,4\n")
    real = getattr(ingest_plan, at)

    def cut_off(*args, **options):
        real(*args, **options)
        raise Interrupted

    monkeypatch.setattr(ingest_plan, at, cut_off)
    with pytest.raises(Interrupted):
        ingest(spark, zones, new_partition=mode)
    monkeypatch.undo()
    again = ingest(spark, zones, new_partition=mode)
    # Once a run is in the ledger, nothing is left to do but to delete its inputs.
    assert again["files_processed"] == (0 if at in ("acknowledge", "retire") else 1)
    assert left(zones, "landing") == [] and len(left(zones, "quarantine")) == 2
    assert lake(spark, zones) == [
        ("a", "2025-12-02", "NEG", 9),
        ("b", "2025-12-15", "POS", 2),
        ("d", "2025-12-15", "POS", 4),
    ]
    assert os.listdir(f"{zones.ledger}/_started") == []


def test_a_broken_deletion_is_made_up_for(spark, zones, put, monkeypatch):
    from labflow.plans import deletion

    put("landing", "a.csv", HEAD + "a,2025-12-01,POS,1\nb,2025-12-15,POS,2\nc,2025-12-15,POS,2\n")
    ingest(spark, zones)
    put("requests", "r.csv", "sample_id,test_date\na,2025-12-01\nb,2025-12-16\n")
    real = deletion.replace_partitions

    def cut_off(*args, **options):
        real(*args, **options)
        raise Interrupted

    monkeypatch.setattr(deletion, "replace_partitions", cut_off)
    with pytest.raises(Interrupted):
        delete(spark, zones)
    monkeypatch.undo()
    assert left(zones, "requests") == ["r.csv"]
    assert delete(spark, zones)["files_processed"] == 1
    assert left(zones, "requests") == [] and [s for s, *_ in lake(spark, zones)] == ["c"]


def test_many_runs_leave_few_files(spark, zones):
    from datetime import datetime

    now = datetime(2025, 12, 1)
    for i in range(60):
        commit.append_log(spark.createDataFrame([(i,)], "n int"), f"{zones.logs}/numbers", now)
    assert len(_parts(f"{zones.logs}/numbers/month=2025-12")) <= commit.MOST_FILES + 1
    assert rows(spark.read.parquet(f"{zones.logs}/numbers"), "n") == sorted([(i,) for i in range(60)], key=str)


def test_consumed_files_are_not_opened_again(spark, zones, put):
    """A file that was consumed and kept may even be unreadable by now."""
    put("landing", "old.csv", DAY1)
    os.utime(f"{zones.landing}/old.csv", (1_700_000_000, 1_700_000_000))
    ingest(spark, zones, retire_inputs=False)
    put("landing", "new.csv", HEAD + "TEST-003,2025-12-01,POS,1\n")
    todo = pending_files(spark, zones, "landing")
    scan = feeds.read_landing(spark, zones.landing, todo)
    assert scan.files == ["new.csv"] and rows(scan.rows, "sample_id") == [("TEST-003",)]
    since = todo.agg(F.min("modificationTime")).first()[0]
    lines = feeds._lines(spark, zones.landing, "*.csv", since, False)
    assert [os.path.basename(f) for f in {r.path for r in lines.select("path").collect()}] == ["new.csv"]
    assert ingest(spark, zones, retire_inputs=False) == counters(1, 0, 1, 0)


def test_stream_takes_each_file_once(spark, zones, put, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    put("landing", "a.csv", DAY1)
    ingest_new_files(spark, zones, checkpoint, retire_inputs=False)
    put("landing", "b.csv", "viral_load,result,test_date,sample_id\n9,N/A,2025-12-04,TEST-001\n")
    ingest_new_files(spark, zones, checkpoint, retire_inputs=False)
    ingest_new_files(spark, zones, checkpoint, retire_inputs=False)
    assert lake(spark, zones)[0] == ("TEST-001", "2025-12-04", "N/A", 9)
    assert rows(feeds.read_runs(spark, zones.logs), "rows_inserted", "rows_updated") == [(0, 1), (2, 0)]
    # A repeated micro-batch finds its files in the ledger.
    ingest_new_files(spark, zones, str(tmp_path / "other"), retire_inputs=False)
    assert feeds.read_runs(spark, zones.logs).count() == 2


def test_the_stream_says_which_files_are_ingested(spark, zones, put, tmp_path):
    from labflow.streaming import incremental

    checkpoint = str(tmp_path / "checkpoint")
    put("landing", "a.csv", HEAD + "A,2025-01-06,POS,1\n")
    put("landing", "b.csv", HEAD + "B,2025-01-06,POS,1\n")
    seen = incremental.landing_files

    def one_file(spark, zones, per_batch=None):
        return seen(spark, zones, per_batch).filter(F.col("path").endswith("a.csv"))

    incremental.landing_files = one_file
    try:
        ingest_new_files(spark, zones, checkpoint)
    finally:
        incremental.landing_files = seen
    assert left(zones, "landing") == ["b.csv"] and [s for s, *_ in lake(spark, zones)] == ["A"]
    # A broken run's files wait for the next, also without anything new.
    name = f"file:{zones.landing}/b.csv"
    waiting = spark.createDataFrame([(name, 1, None)], "path string, length bigint, modificationTime timestamp")
    for _ in range(2):
        waiting.write.mode("overwrite").parquet(f"{checkpoint}/waiting/batch=7")
    ingest_new_files(spark, zones, checkpoint)
    assert left(zones, "landing") == [] and [s for s, *_ in lake(spark, zones)] == ["A", "B"]


@pytest.mark.parametrize("per_batch", [1, 1000])
def test_the_last_row_does_not_depend_on_micro_batches(spark, zones, put, tmp_path, per_batch):
    for name, load in (("c.csv", 3), ("a.csv", 1), ("b.csv", 2)):
        put("landing", name, HEAD + f"A,2025-01-06,POS,{load}\n")
    ingest_new_files(spark, zones, str(tmp_path / "checkpoint"), per_batch=per_batch)
    assert [v for *_, v in lake(spark, zones)] == [3]
    assert feeds.read_runs(spark, zones.logs).count() == 1


def test_a_hot_partition_is_written_by_many_tasks(spark, zones, monkeypatch):
    """Most rows fall into one week; AQE splits it instead of handing it to one task."""
    from labflow.sinks.files import write_feed

    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200kb",
        "spark.sql.files.maxPartitionBytes": "400kb",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        feed = spark.range(60_000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("sample_id"),
            F.when(F.col("id") % 100 == 0, "2025-11-03").otherwise("2025-12-01").alias("test_date"),
            F.lit("POS").alias("result"),
            F.col("id").cast("string").alias("viral_load"),
            F.lit("big.csv").alias("source_file"),
            F.col("id").alias("row_pos"),
        )
        write_feed(feed, zones.landing)
        assert ingest(spark, zones) == counters(1, 0, 60_000, 0)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(_parts(f"{zones.lake}/year=2025/week=49")) >= 3
    assert read_lake(spark, zones.lake).count() == 60_000


def test_history_is_filtered_without_a_shuffle(spark, zones, put):
    from labflow.operators.upsert import kept_history

    put("landing", "a.csv", HEAD + "a,2025-12-01,POS,1\nb,2025-12-15,POS,2\n")
    ingest(spark, zones)
    keys = spark.createDataFrame([(2025, 49, "a")], "year int, week int, sample_id string")
    kept = kept_history(read_lake(spark, zones.lake, partitions=[(2025, 49), (2025, 51)]), F.broadcast(keys))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert rows(kept, "sample_id") == [("b",)]
