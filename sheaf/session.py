"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings the jobs rely on; a cluster may set more. Partition counts and memory are
# left to the cluster, apart from letting adaptive execution merge and split them.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a speculative copy of a model task would pay for its calls twice
    "spark.speculation": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # requests are long texts; the default of 10000 rows per batch could fill a worker
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def work_folder(spark: SparkSession) -> str:
    """Shared folder for tables written between stages.

    Taken from ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder; on a cluster the executors could not see it.
    """
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="sheaf-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table of fewer files than the session has cores.

    A small table may be one file with one row group, which a single task would read and
    then parse alone. Larger ones, the normal case on a cluster, are left untouched. Only
    the names of the files are asked for; nothing is planned or run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def few_files(df: DataFrame) -> DataFrame:
    """At most two partitions for each core of the session, to be staged as so many files.

    For tables that come out of a shuffle, which may have far more partitions than they need.
    Nothing is shuffled: each task goes through its partitions in turn, those of a split skewed
    key included. Without Hadoop's native library, a file on a local disk costs the executor
    three ``chmod`` processes, and until such a process has begun its program, the
    executor's memory counts twice for whoever measures or limits it by process.
    """
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write the table to the shared folder and read it back.

    Cuts the lineage: whatever is computed later never repeats model calls or row
    positions, also after an executor is lost.
    """
    spark = df.sparkSession
    path = path or staged_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table_if_any(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema(schema).parquet(path) if fs.exists(hadoop_path) else None
