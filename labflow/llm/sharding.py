"""Contiguous shards of near-equal size from global prefix sums of byte sizes; DataFrame functions only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from labflow.llm.common import Scratch, with_columns

# More blocks than tasks, so that blocks dealt out by hash fill the tasks evenly.
BLOCKS_PER_TASK = 4


def text_size(text):
    """UTF-8 bytes of a text plus 1; a null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(1)


def shard(rows, order, size, shards=16):
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (place in the shard, from 0).

    Rows in the order of the column ``order`` (null first, ties in the order of the files) are laid end to end; a row
    belongs to the shard that holds the middle of its bytes, so shard sizes differ from an equal target by at most the
    size of the largest row. The column ``size`` must be positive. An empty table gives no rows; fewer rows than shards
    leave shards empty. Columns called ``shard`` or ``slot`` in the input give way.

    The rows are range-partitioned by the order and written once to the shared folder, which fixes the partition
    numbers. Totals of the partitions (one row each) give every partition its start; running sums inside a partition
    do the rest. Only these totals are broadcast: as many rows as there are partitions, whatever the data.
    """
    spark = rows.sparkSession
    blocks = BLOCKS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "shard")
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    laid, _ = scratch.table(
        rows.select(*[F.col(f"`{c}`") for c in kept], F.monotonically_increasing_id().alias("_file_order"))
        .repartitionByRange(blocks, F.col(f"`{order}`").asc_nulls_first(), F.col("_file_order"))
        .withColumn("_block", F.spark_partition_id())
    )
    size = F.col(f"`{size}`")
    totals = laid.groupBy("_block").agg(F.sum(size).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    # One row per block from here to the broadcast: the window below sees block totals only.
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "_block",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_all_bytes"),
    )
    inside = Window.partitionBy("_block").orderBy(F.col(f"`{order}`").asc_nulls_first(), "_file_order")
    placed = (
        laid.withColumn("_end", F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_nth", F.row_number().over(inside))
        .join(F.broadcast(starts), "_block")
    )
    # Twice the middle, to stay with whole numbers.
    middle = 2 * (F.col("_bytes_before") + F.col("_end")) - size
    number = F.expr(f"least({shards - 1}, int(_middle * {shards} div (2 * _all_bytes)))")
    placed = (
        placed.withColumn("_middle", middle.cast("decimal(38,0)"))
        .withColumn("shard", number)
        .withColumn("_place", F.col("_rows_before") + F.col("_nth") - 1)
    )
    placed, _ = scratch.table(placed.select(*[F.col(f"`{c}`") for c in kept], "shard", "_place"))
    first = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("_place").alias("_first"))
    return (
        placed.join(F.broadcast(first), F.col("shard") == F.col("_shard"))
        .withColumn("slot", F.col("_place") - F.col("_first"))
        .drop("_shard", "_first", "_place")
    )
