"""Session defaults and the shared folder that long jobs write through."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on. Sizes of shuffles are left to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # cipher keys written as literals must not show up in plans
    "spark.sql.redaction.string.regex": "(?i)aes_(en|de)crypt.*",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


#: Spark's switch that removes the shuffle files of a job at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Bytes at which Spark ends an Arrow batch; the default is 10,000 rows of any width, held by the task and by its worker.
BATCH_BYTES = 4 << 20


def build_session(app: str = "terrace", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="terrace-"))
    return context.getCheckpointDir().rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session end at ``BATCH_BYTES``; it is read when a plan runs, and changes no result."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there."""
    return write_table(df, scratch_path(df.sparkSession, label))


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back; the shuffle files of its job go as soon as the table stands."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP)
    conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of this run's own that a later round has replaced."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
