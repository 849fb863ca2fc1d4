"""Streaming operators: duplicates, joins, late rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.times import micros
from terrace.plans.joins import all_of
from terrace.sources.tables import path_exists
from terrace.streaming.runs import write_batch


def event_time(df: DataFrame, time: str) -> DataFrame:
    """Wall-clock timestamps as instants, which watermarks need (session time zone UTC)."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def dedupe_stream(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of event time; state is bounded by it."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def enrich_stream(stream: DataFrame, static: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Stream-static join; the static side is read again for every micro-batch."""
    return stream.join(static, on, how)


def _micros_of(df: DataFrame, time: str) -> Column:
    """Microseconds of an instant or of a wall-clock time, whichever the column holds."""
    return F.unix_micros(time) if dict(df.dtypes)[time] == "timestamp" else micros(time)


def join_streams_interval(
    a: DataFrame, b: DataFrame, on: list[str], a_time: str, b_time: str, lower_s: int, upper_s: int, how: str = "inner"
) -> DataFrame:
    """Pairs with equal ``on`` and ``b_time - a_time`` within ``[lower_s, upper_s]`` seconds.

    ``how`` is inner or left. Column names other than ``on`` must differ. Streams need watermarks
    on both sides beforehand. Time is part of the equality: ``b`` is listed in the one or two
    slots its partners can lie in, so a hot key is spread over time and only neighbours are
    compared, in batch and in the state of a stream.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if lower_s > upper_s:
        raise ValueError("lower bound above upper bound")
    right = b.select(*[F.col(k).alias(f"__b_{k}") for k in on], *[c for c in b.columns if c not in on])
    same = [F.col(k) == F.col(f"__b_{k}") for k in on]
    near = F.col(b_time).between(
        F.col(a_time) + F.expr(f"INTERVAL {lower_s} SECONDS"), F.col(a_time) + F.expr(f"INTERVAL {upper_s} SECONDS")
    )
    width = max(upper_s - lower_s, 1) * 1_000_000

    def slot(us: Column) -> Column:
        return F.floor(us / F.lit(width)).cast("bigint")

    left = a.withColumn("__slot", slot(_micros_of(a, a_time)))
    first = slot(_micros_of(b, b_time) - upper_s * 1_000_000)
    last = slot(_micros_of(b, b_time) - lower_s * 1_000_000)
    right = right.withColumn("__b_slot", F.explode(F.sequence(first, last)))
    same.append(F.col("__slot") == F.col("__b_slot"))
    joined = left.join(right, all_of([*same, near]), "left_outer" if how == "left" else "inner")
    return joined.select(*a.columns, *[c for c in b.columns if c not in on])


def late_splitter(
    time: str, delay_s: int, on_time_path: str, late_path: str, marks_path: str
) -> Callable[[DataFrame, int], None]:
    """Handler that writes rows older than ``delay_s`` behind *earlier* batches to ``late_path``.

    A native watermark would drop such rows unseen. Below ``marks_path`` each batch number keeps
    one row, the newest event time up to and including that batch, so a batch reads the row of
    the batch before it only. A repeated batch reads the same row again and replaces what it
    wrote, so it decides the same way.
    """

    def newest_before(spark: SparkSession, batch_id: int):
        """Newest event time of the batches before this one, None for the first."""
        if not path_exists(spark, marks_path):
            return None
        last = f"{marks_path}/batch_id={batch_id - 1}"
        if path_exists(spark, last):
            return spark.read.parquet(last).first()["newest"]
        earlier = spark.read.parquet(marks_path).filter(F.col("batch_id") < batch_id)
        return earlier.agg(F.max("newest")).first()[0]

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = newest_before(batch.sparkSession, batch_id)
        newest = F.max(time)
        if seen is not None:
            newest = F.greatest(newest, F.lit(seen).cast(batch.schema[time].dataType))
        if seen is None:
            is_late = F.lit(False)
        else:
            is_late = F.coalesce(F.col(time) < F.lit(seen) - F.expr(f"INTERVAL {delay_s} SECONDS"), F.lit(False))
        rows = batch.persist()
        write_batch(rows.filter(~is_late), on_time_path, batch_id)
        write_batch(rows.filter(is_late), late_path, batch_id)
        write_batch(rows.agg(newest.alias("newest")), marks_path, batch_id)
        rows.unpersist()

    return handle
