"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Recording the call site of every column expression is most of the planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Intermediate data go here when the session names no folder. The path has no scheme, so it
# lies in the default file system, which is the shared one on a cluster.
SCRATCH = "/tmp/checkpoints/playtide"


# So many rows of a few short columns take some tens of megabytes to sort.
ROWS_PER_TASK = 250_000


def build_session(app_name: str = "playtide", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators were planned for.

    The number of shuffle partitions is left to the caller: a cluster job sets
    it from its input size and lets AQE coalesce, a test sets it to its cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the one the session names, else one of this application's own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if default.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{SCRATCH}/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Dealt by ``keys`` to tasks of about ``ROWS_PER_TASK`` rows each, for a table that ``rows`` grow with.

    Joins and sums by the keys then hold a bounded part of it in each task, whatever the session's number of
    shuffle partitions and however large the input.
    """
    return df.repartition(-(-rows // ROWS_PER_TASK) or 1, *keys)


def cut(df: DataFrame) -> DataFrame:
    """Materialise a small intermediate in the shared folder and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
