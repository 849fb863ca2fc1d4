"""Running a stream to the end of its input and idempotent writes from micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from terrace.operators.changes import GONE, history_from_changes, live_rows, merge_changes
from terrace.operators.gold import partial_aggregate, refresh_aggregate
from terrace.plans.joins import null_safe_join
from terrace.session import discard, scratch_path
from terrace.sources.tables import path_exists

#: Micro-batches between two folds of a store.
FOLD_EVERY = 16
#: Folders over which the keys of a stored history are spread; a micro-batch rewrites those it touches.
BUCKETS = 64
BUCKET, MARK = "__bucket", "__mark"


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append everything available to a table of files, then open that table."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_to_scratch(stream: DataFrame, label: str) -> DataFrame:
    """Append everything available to a fresh table in the shared folder."""
    spark = stream.sparkSession
    return run_to_files(stream, scratch_path(spark, label), scratch_path(spark, f"{label}-progress"))


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Feed every micro-batch of the available input to ``handle(batch, batch_id)``."""
    query = (
        stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store one batch under its number; a repeated batch replaces itself."""
    df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_id").parquet(path)


def _folders(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """The folders ``<prefix>=<number>`` below ``path`` by number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return {int(n.split("=", 1)[1]): f"{path}/{n}" for n in names if n.startswith(f"{prefix}=")}


def _bases(spark: SparkSession, path: str) -> dict[int, str]:
    """Complete folds of a batch store by their last batch: Spark marks a table when all of it is written."""
    return {k: f for k, f in _folders(spark, f"{path}-base", "upto").items() if path_exists(spark, f"{f}/_SUCCESS")}


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete fold and the batches after it; all batches where none was folded."""
    bases = _bases(spark, path)
    stored = spark.read.parquet(path)
    if not bases:
        return stored.drop("batch_id")
    last = max(bases)
    return spark.read.parquet(bases[last]).unionByName(stored.filter(F.col("batch_id") > last).drop("batch_id"))


def fold_batches(spark: SparkSession, path: str, batch_id: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge all batches up to ``batch_id`` into one table, so that a store stays a bounded number of folders.

    ``merge`` must give the same for merged rows and later ones as for all of them. A fold that is killed is
    not complete and is ignored; one that is done already is not repeated. What the fold before this one
    replaced is removed, so that readers of the last state still find their files.
    """
    bases = _bases(spark, path)
    if bases and max(bases) >= batch_id:
        return
    merge(read_batches(spark, path)).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}-base/upto={batch_id}")
    if bases:
        last = max(bases)
        gone = {k: f for k, f in _folders(spark, f"{path}-base", "upto").items() if k < last}
        gone_batches = {k: f for k, f in _folders(spark, path, "batch_id").items() if k <= last}
        for folder in [*gone.values(), *gone_batches.values()]:
            discard(spark, folder)


def _folding(path: str, reduce: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], every: int) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(reduce(batch), path, batch_id)
        if batch_id % every == every - 1:
            fold_batches(spark, path, batch_id, merge)

    return handle


def scd1_writer(path: str, keys: list[str], seq: list[str], delete_when: Column, fold_every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    """Handler that keeps, per micro-batch, the newest change of each key below ``path``.

    Every ``fold_every`` batches these become one table (deletions stay in it as such, so that late changes
    still meet them); :func:`read_scd1` merges it with the batches since.
    """

    def newest(rows: DataFrame) -> DataFrame:
        return merge_changes(None, rows, keys, seq, delete_when)

    def merged(rows: DataFrame) -> DataFrame:
        return merge_changes(None, rows, keys, seq, F.col("_deleted"))

    return _folding(path, newest, merged, fold_every)


def read_scd1(spark: SparkSession, path: str, keys: list[str], seq: list[str]) -> DataFrame:
    """Current rows of a table kept by :func:`scd1_writer`."""
    changes = read_batches(spark, path)
    return live_rows(merge_changes(None, changes, keys, seq, F.col("_deleted")))


def run_updates(stream: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run an aggregate in update mode and open its last state: of each key the row of its newest batch.

    With a watermark Spark forgets groups that can change no more, so state stays bounded however long the
    stream runs, and what is written are the groups that changed.
    """
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    run_batches(stream, lambda batch, batch_id: write_batch(batch, path, batch_id), scratch_path(spark, f"{label}-progress"), "update")
    rest = [c for c in stream.columns if c not in keys]
    stored = spark.read.schema(StructType([*stream.schema.fields, StructField("batch_id", LongType())])).parquet(path)
    newest = stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("__last"))
    return newest.select(*keys, "__last.*").select(*stream.columns)


def _versions(spark: SparkSession, stored: str, below: int | None = None) -> dict[int, dict[int, str]]:
    """Per bucket its folders by batch, of batches written to their end (and below ``below``)."""
    out: dict[int, dict[int, str]] = {}
    for batch_id, folder in _folders(spark, stored, "batch_id").items():
        if (below is None or batch_id < below) and path_exists(spark, f"{folder}/_SUCCESS"):
            for bucket, part in _folders(spark, folder, BUCKET).items():
                out.setdefault(bucket, {})[batch_id] = part
    return out


def scd2_writer(
    path: str, keys: list[str], seq: list[str], delete_when: Column, track: list[str],
    chunk: Column | None = None, buckets: int = BUCKETS, fold_every: int = FOLD_EVERY,
) -> Callable[[DataFrame, int], None]:
    """Handler that keeps the history of all changes below ``path``; :func:`read_history` opens it.

    Changes are appended to a log. Keys of the batch are replayed from the log, which is exact for late and
    repeated changes; the history of other keys in the same buckets is taken over, other buckets are neither
    read nor written. A batch writes its buckets under its own number and reads only those of earlier batches, so
    a repeated batch replaces itself. Of each bucket the newest version and the one before it stay.
    """
    log, stored = f"{path}-log", f"{path}-history"

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
        write_batch(batch.select(*keys, *track, *seq, F.coalesce(delete_when, F.lit(False)).alias(GONE), bucket), log, batch_id)
        if batch_id not in _folders(spark, log, "batch_id"):
            return  # an empty batch
        fresh = spark.read.parquet(f"{log}/batch_id={batch_id}")
        marks = fresh.select(BUCKET).distinct()
        touched = [r[0] for r in marks.collect()]  # at most ``buckets``
        names = fresh.select(*keys).distinct()
        changes = null_safe_join(read_batches(spark, log).filter(F.col(BUCKET).isin(touched)), names, keys, "left_semi")
        whole = history_from_changes(changes, keys, seq, F.col(GONE), track, chunk)
        before = _versions(spark, stored, batch_id)
        held = [before[b][max(before[b])] for b in touched if b in before]
        if held:
            others = spark.read.parquet(*held).filter(~F.col(MARK)).drop(MARK)
            whole = whole.unionByName(null_safe_join(others, names, keys, "left_anti"))
        # a bucket without rows has a folder too, so that it hides its older version
        rows = whole.select("*", bucket, F.lit(False).alias(MARK)).unionByName(marks.withColumn(MARK, F.lit(True)), allowMissingColumns=True)
        rows.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(
            f"{stored}/batch_id={batch_id}"
        )
        for b in touched:
            for old in sorted(before.get(b, {}))[:-1]:
                discard(spark, before[b][old])
        for folder in _folders(spark, stored, "batch_id").values():
            if not _folders(spark, folder, BUCKET):
                discard(spark, folder)
        if batch_id % fold_every == fold_every - 1:
            fold_batches(spark, log, batch_id, lambda rows: rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET))

    return handle


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history kept by :func:`scd2_writer`: of each bucket its newest complete version."""
    versions = _versions(spark, f"{path}-history")
    if not versions:
        raise ValueError("no batch with rows has been stored")
    newest = [folders[max(folders)] for folders in versions.values()]
    return spark.read.parquet(*newest).filter(~F.col(MARK)).drop(MARK)


def aggregate_writer(path: str, keys: list[str], measure: Column, member: Column, fold_every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    """Handler that stores mergeable partials of each micro-batch below ``path`` and folds them every ``fold_every`` batches."""

    def partials(rows: DataFrame) -> DataFrame:
        return partial_aggregate(rows, keys, measure, member)

    def merged(rows: DataFrame) -> DataFrame:
        return refresh_aggregate(rows, rows.limit(0), keys)

    return _folding(path, partials, merged, fold_every)


def read_aggregate(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    partials = read_batches(spark, path)
    return refresh_aggregate(partials, partials.limit(0), keys)
