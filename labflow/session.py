"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators rely on. AQE splits skewed shuffle partitions and turns a join into a broadcast join when
# the measured size of one side allows it. Lake partitions are many and mostly small, so writing costs per file and is
# spread over all cores even where the rows would fit one task.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Recording the Python line of every column expression doubles the time to build the wide ones used here.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64kb",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master=None, app="labflow", **extra):
    """A session with the settings above; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark):
    """Folder for written intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="labflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Folder of the job that is running, if one is.
_of_run = []


@contextmanager
def run_scratch(spark):
    """A scratch folder for one job, removed when it ends, however it ends."""
    root = f"{scratch_root(spark)}/labflow/run-{uuid.uuid4().hex}"
    _of_run.append(root)
    try:
        yield root
    finally:
        _of_run.remove(root)
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def new_scratch(spark, label):
    """A path under the scratch folder, or under that of the job, that nothing else uses."""
    root = _of_run[-1] if _of_run else f"{scratch_root(spark)}/labflow"
    return f"{root}/{label}-{uuid.uuid4().hex}"


def written(spark, df, label):
    """A frame as a table in the scratch folder.

    Later steps neither recompute it nor depend on executors that held it, and the planner knows its size.
    """
    path = new_scratch(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
