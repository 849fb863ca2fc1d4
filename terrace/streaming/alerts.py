"""Continuous burst alerts from micro-batches, with a small table of what went before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.functions.times import micros
from terrace.operators.audit import detect_bursts
from terrace.plans.chunks import HOT_ROWS, neighbour, tag_chunks, untag
from terrace.session import discard, scratch_path, write_table
from terrace.sources.tables import path_exists
from terrace.streaming.runs import run_batches, write_batch

#: Spans after which a silent key is forgotten.
KEEP_SPANS = 100


def alert_writer(
    path: str, tail: str, time: str, cond: Column, n: int, span_seconds: int, keys: list[str],
    keep_spans: int = KEEP_SPANS, hot_rows: int = HOT_ROWS,
) -> Callable[[DataFrame, int], None]:
    """Handler that stores (keys, alert_at) of each micro-batch below ``path``: one alert when ``n`` matching
    events lie in the span that ends at an event, the next one only after the burst has ended.

    Below ``tail`` it keeps, per batch, what later events need: of each key the instants of its last span,
    ``n - 1`` at most, with their counts and whether a burst was on. A batch meets the tail of the one before,
    so one that is delivered again gives the same again. Instants of a batch that came late are judged by what
    the tail still holds, and those judged before give no second alert. Keys silent for ``keep_spans`` spans
    before the newest event of all leave the tail. Rows without a time count for nothing.
    A hot key is spread by time slots and chunks, as in batch.
    """
    if n < 2:
        raise ValueError("a burst needs at least two events")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.filter(cond).filter(F.col(time).isNotNull()).groupBy(*keys, time).agg(F.count(F.lit(1)).alias("n_here"))
        fresh = fresh.withColumns({"was_on": F.lit(False), "is_new": F.lit(True)})
        before = f"{tail}/batch={batch_id - 1}"
        if batch_id and path_exists(spark, before):
            fresh = fresh.unionByName(spark.read.parquet(before).withColumn("is_new", F.lit(False)))
        # an instant that more events reach later is judged once
        met = fresh.groupBy(*keys, time).agg(F.sum("n_here").alias("n_here"), F.bool_or("was_on").alias("was_on"), F.bool_and("is_new").alias("is_new"))
        scratch = [scratch_path(spark, f"alert-{name}") for name in ("instants", "judged")]
        met = write_table(met, scratch[0])
        counted = detect_bursts(met, time, F.lit(True), 1, span_seconds, keys, weight=F.col("n_here"))
        on = met.alias("m").join(
            counted.select(*keys, time, "n_in_span").alias("c"),
            [F.col(f"m.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, time]],
        ).select("m.*", (F.col("m.was_on") | (F.col("c.n_in_span") >= n)).alias("on"))
        on = write_table(on, scratch[1])
        seen = untag(neighbour(tag_chunks(on, keys, time, None, hot_rows), [time], {"__on_before": F.col("on")}))
        starts = seen.filter(F.col("is_new") & F.col("on") & ~F.coalesce("__on_before", F.lit(False)))
        write_batch(starts.select(*keys, F.col(time).alias("alert_at")), path, batch_id)
        # Spark keeps so few instants of a key in each task before they meet
        latest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(time)))
        end = on.groupBy(*keys).agg(F.max(micros(time)).alias("__end"))
        kept = on.withColumn("__place", latest).filter(F.col("__place") < n)
        kept = kept.alias("k").join(end.alias("e"), [F.col(f"k.{k}").eqNullSafe(F.col(f"e.{k}")) for k in keys])
        newest = on.agg(F.max(micros(time))).scalar()
        inside = (F.col("__end") - micros(F.col(f"k.{time}")) <= span_seconds * 1_000_000) & (newest - F.col("__end") <= keep_spans * span_seconds * 1_000_000)
        # of an instant no more than n events matter
        rows = kept.filter(inside).select(*[F.col(f"k.{c}").alias(c) for c in [*keys, time]], F.least("n_here", F.lit(n)).alias("n_here"), F.col("on").alias("was_on"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{tail}/batch={batch_id}")
        for path_done in [*scratch, f"{tail}/batch={batch_id - 2}"]:
            discard(spark, path_done)

    return handle


def alert_stream(df: DataFrame, time: str, cond: Column, n: int, span_seconds: int, keys: list[str]) -> DataFrame:
    """Run a stream to the end of its input and open its alerts (keys, alert_at)."""
    spark: SparkSession = df.sparkSession
    path, tail = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-tail")
    run_batches(df, alert_writer(path, tail, time, cond, n, span_seconds, keys), scratch_path(spark, "alerts-progress"))
    schema = df.select(*keys, F.col(time).alias("alert_at")).schema
    return spark.read.schema(schema).parquet(path).select(*keys, "alert_at")
