"""Incremental landing run on Structured Streaming.

The stream finds the files: every micro-batch writes their names to a table of files that wait, under its own number, so
that a batch that is repeated writes the same again. When the stream has caught up, the files that wait are ingested
together, by the batch function and in the order of names and positions, however the stream cut them into batches. Files
the stream did not name are not read.
"""

from labflow.plans.ingest import ingest
from labflow.sinks.commit import pending, read_ledger
from labflow.sources.feeds import list_files
from labflow.sources.storage import Folder, has_files

FILE = "path string, modificationTime timestamp, length bigint, content binary"
# Below a stream's checkpoint.
WAITING = "waiting"


def landing_files(spark, zones, per_batch=None):
    """New landing files as a stream of names, sizes and times; contents are not read."""
    reader = (
        spark.readStream.schema(FILE)
        .format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("ignoreMissingFiles", "true")
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(zones.landing).select("path", "length", "modificationTime")


def read_waiting(spark, checkpoint):
    """Files the stream has named, with the number of the batch; those consumed since are still listed."""
    schema = "path string, length bigint, modificationTime timestamp, batch bigint"
    folder = f"{checkpoint}/{WAITING}"
    if not has_files(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def ingest_new_files(spark, zones, checkpoint, per_batch=None, **options):
    """Ingest whatever the stream finds new and stop; returns the finished query.

    The ledger says what earlier runs consumed, so a run that broke off between the stream and the ingest is made up for
    by the next one, which finds the files still waiting. When all are consumed the table of waiting files is emptied.
    Empty files never reach the stream; they are unreadable and stay where they are.
    """

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{checkpoint}/{WAITING}/batch={number}")

    query = (
        landing_files(spark, zones, per_batch)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    waiting = read_waiting(spark, checkpoint)
    if not waiting.isEmpty():
        # A file that was uploaded again since is read as it is now.
        there = list_files(spark, zones.landing, "*.csv").join(waiting.select("path").distinct(), "path", "left_semi")
        if not pending(there, read_ledger(spark, zones)).isEmpty():
            ingest(spark, zones, files=there, **options)
        Folder(spark, f"{checkpoint}/{WAITING}").delete()
    return query
