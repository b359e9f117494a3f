"""Merge a batch of valid records into the table: keep-last, and what the merge changed.

History and batch are frames with the record columns. The batch, and a history that may hold duplicates, also carry the
columns of ``order`` (file name, then position in the file); "last" is decided by them and never by arrival order.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labflow.functions.partition import KEY, touched_partitions, with_partition
from labflow.schema import RECORD

ORDER = ("source_file", "row_pos")
COLUMNS = RECORD.fieldNames()
NEW_PARTITION = ("dedup", "append")


def _tagged(df, is_batch, order):
    """Record columns, ``is_batch`` and order columns; order columns a frame lacks become null."""
    keep = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in order]
    return df.select(*COLUMNS, F.lit(is_batch).alias("is_batch"), *keep)


def union_batch(history, batch, order=ORDER):
    """History and batch as one frame, with ``is_batch`` telling them apart."""
    return _tagged(history, False, order).unionByName(_tagged(batch, True, order))


def keep_last(df, key, order):
    """The last row per key.

    ``row_number() = 1`` plans a group limit before the exchange, so each map task sends at most one row per key and
    a key with a third of all rows does not gather in one reducer.
    """
    last_first = [F.col(c).desc_nulls_last() for c in order]
    window = Window.partitionBy(*key).orderBy(*last_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _existing(history):
    return touched_partitions(with_partition(history))


def split_new_partitions(history, batch):
    """Batch rows of partitions the history has, and of partitions it lacks.

    The partition list is broadcast: it has one pair per calendar week (see ``MAX_PARTITIONS``), whatever the size of
    the history.
    """
    existing = F.broadcast(_existing(history))
    batch = with_partition(batch)
    return (
        batch.join(existing, KEY, "left_semi"),
        batch.join(existing, KEY, "left_anti"),
    )


def upsert_partitioned(history, batch, order=ORDER, new_partition="dedup", keep=()):
    """Keep the last row per ``(year, week, sample_id)`` of history followed by batch.

    A sample is unique inside its week only. ``new_partition="append"`` writes the rows of partitions the history
    lacks as they are, duplicates included. ``keep`` names order columns to return as well.
    """
    key = [*KEY, "sample_id"]
    if new_partition not in NEW_PARTITION:
        raise ValueError(f"new_partition must be one of {NEW_PARTITION}")
    added = None
    if new_partition == "append":
        batch, added = split_new_partitions(history, batch)
    rows = with_partition(union_batch(history, batch, order))
    merged = keep_last(rows, key, ["is_batch", *order]).select(*COLUMNS, *KEY, *keep)
    if added is not None:
        merged = merged.unionByName(added.select(*COLUMNS, *KEY, *keep))
    return merged


def kept_history(history, keys):
    """Rows of an already unique history that the batch does not replace.

    The history is only filtered: where the keys are broadcast it is not shuffled at all. Both frames carry ``year``
    and ``week``.
    """
    return history.join(keys, [*KEY, "sample_id"], "left_anti").select(*COLUMNS, *KEY)


def upsert_global(history, batch, order=ORDER):
    """Keep the last row per ``sample_id`` over the whole table, newest date first."""
    rows = keep_last(union_batch(history, batch, order), ["sample_id"], ["is_batch", *order])
    return rows.select(*COLUMNS).orderBy(F.desc("test_date"), "sample_id")


def _key_presence(history, batch, key):
    """One row per key with the number of rows on both sides; partial counts combine before the shuffle."""
    sides = with_partition(
        history.select("sample_id", "test_date", F.lit(False).alias("is_batch")).unionByName(
            batch.select("sample_id", "test_date", F.lit(True).alias("is_batch"))
        )
    )
    return sides.groupBy(*key).agg(
        F.count_if(~F.col("is_batch")).alias("history_rows"),
        F.count_if("is_batch").alias("batch_rows"),
    )


def upsert_counts(history, batch, new_partition="dedup"):
    """Inserted and updated samples per partition the batch touches.

    Updated means the id is on both sides, even with equal values. With ``new_partition="append"`` a new partition
    counts its rows, not its ids. History of other partitions is left out before anything is shuffled; the list of
    touched ones has one pair per calendar week (see ``MAX_PARTITIONS``).
    """
    touched = touched_partitions(with_partition(batch.select("test_date")))
    inside = with_partition(history).join(F.broadcast(touched), KEY, "left_semi")
    keys = _key_presence(inside, batch, [*KEY, "sample_id"])
    per_partition = keys.groupBy(*KEY).agg(
        F.count_if((F.col("batch_rows") > 0) & (F.col("history_rows") == 0)).alias("ids_inserted"),
        F.count_if((F.col("batch_rows") > 0) & (F.col("history_rows") > 0)).alias("rows_updated"),
        F.sum("batch_rows").alias("batch_rows"),
        F.sum("history_rows").alias("history_rows"),
    )
    is_new = F.col("history_rows") == 0
    counted_rows = is_new & F.lit(new_partition == "append")
    return per_partition.filter("batch_rows > 0").select(
        *KEY,
        F.when(counted_rows, F.col("batch_rows")).otherwise(F.col("ids_inserted")).alias("rows_inserted"),
        "rows_updated",
        is_new.alias("is_new"),
    )


def upsert_totals(counts):
    """The run's totals of ``upsert_counts`` in one row."""
    return counts.agg(
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum("rows_updated"), F.lit(0)).alias("rows_updated"),
        F.count(F.lit(1)).alias("partitions"),
    )


def global_counts(history, batch):
    """Inserted and updated samples, and rows before and after, of ``upsert_global`` in one row."""
    keys = _key_presence(history, batch, ["sample_id"])
    return keys.agg(
        F.count_if((F.col("batch_rows") > 0) & (F.col("history_rows") == 0)).alias("rows_inserted"),
        F.count_if((F.col("batch_rows") > 0) & (F.col("history_rows") > 0)).alias("rows_updated"),
        F.coalesce(F.sum("history_rows"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )
