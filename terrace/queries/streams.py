"""Streams over the given tables, run to the end of their input; results are opened from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import masks
from terrace.functions.money import cents
from terrace.functions.times import year_of
from terrace.operators import access, audit, changes, cost, gold, protection, refine
from terrace.queries.access import redacted_sql
from terrace.queries.ingest import HISTORY_SQL
from terrace.queries.inputs import PRICES_SQL, prices
from terrace.queries.registry import query
from terrace.session import scratch_path, write_through
from terrace.sources import files
from terrace.sources.tables import folder_bytes, is_folder, table, table_stream
from terrace.streaming import alerts, flows, runs

#: Size of the files in which slices of a table arrive.
SLICE_FILE_BYTES = 64 << 20


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _arriving_events(spark: SparkSession, sf: str) -> DataFrame:
    """All events as a stream that takes four micro-batches: one slice of the time span after the other."""
    log = table(spark, sf, "events")
    parts = F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75])
    cuts = log.agg(parts.alias("cuts")).first()["cuts"] or []
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    slot = sum((F.coalesce(at >= F.lit(c), F.lit(False)).cast("int") for c in cuts), F.lit(0))
    source = scratch_path(spark, "arrivals")
    # each slice is as many files as a micro-batch takes, and files are taken in the order in which they were written
    files_of_slice = 1 + folder_bytes(spark, f"{sf}/events.parquet") // (4 * SLICE_FILE_BYTES)
    for k in range(len(cuts) + 1):
        log.filter(slot == k).repartition(files_of_slice).write.mode("append").parquet(source)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", files_of_slice).parquet(source)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return flows.event_time(_arriving_events(spark, sf), "ts")


@query("SELECT event_id, ts, user_id, event_type, value, props, 'events.parquet' AS _src_file FROM events")
def ingest_files_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Run twice with one checkpoint: the second run finds nothing new."""
    schema = table(spark, sf, "events").schema
    out, progress = scratch_path(spark, "bronze"), scratch_path(spark, "progress")
    path, options = f"{sf}/events.parquet", {}
    if not is_folder(spark, path):
        path, options = sf, {"pathGlobFilter": "events.parquet"}
    for _ in range(2):
        loaded = runs.run_to_files(files.ingest_files_stream(spark, path, "parquet", schema, options), out, progress)
    return loaded.select(*schema.fieldNames(), "_src_file")


@query("SELECT event_id, user_id, event_type, ts FROM events")
def dedupe_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every event delivered twice, in four micro-batches."""
    stream = _event_stream(spark, sf).select("event_id", "user_id", "event_type", "ts")
    once = flows.dedupe_stream(stream.union(stream), ["event_id"], "ts", "1 hour")
    return _ntz(runs.run_to_scratch(once, "deduped"), "ts")


@query("""
SELECT event_id, user_id, event_type, c_mktsegment, c_nationkey FROM events LEFT JOIN customer ON user_id = c_custkey
""")
def enrich_stream(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    stream = _event_stream(spark, sf).select("event_id", "user_id", "event_type")
    return runs.run_to_scratch(flows.enrich_stream(stream, people, ["user_id"]), "enriched")


def _halves(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    a = log.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts"))
    b = log.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return a, b


INTERVAL_SQL = """
SELECT a.user_id, a.event_id AS signup_id, a.ts AS signup_ts, {missing} AS purchase_id, b.ts AS purchase_ts
FROM (SELECT * FROM events WHERE event_type = 'signup') a {how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') b
ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts + INTERVAL 12 HOUR
"""


@query(INTERVAL_SQL.format(how="LEFT", missing="coalesce(b.event_id, -1)"))
def join_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Batch: purchases from an hour before to twelve hours after a signup."""
    a, b = _halves(table(spark, sf, "events"))
    out = flows.join_streams_interval(a, b, ["user_id"], "signup_ts", "purchase_ts", -3600, 12 * 3600, "left")
    return out.na.fill(-1, ["purchase_id"])


@query(INTERVAL_SQL.format(how="", missing="b.event_id"))
def join_streams_interval(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _halves(_event_stream(spark, sf))
    a, b = a.withWatermark("signup_ts", "1 day"), b.withWatermark("purchase_ts", "1 day")
    out = flows.join_streams_interval(a, b, ["user_id"], "signup_ts", "purchase_ts", -3600, 12 * 3600)
    return _ntz(runs.run_to_scratch(out, "pairs"), "signup_ts", "purchase_ts")


@query("""
WITH mark AS (SELECT max(ts) - INTERVAL 1 DAY AS m FROM events WHERE event_type <> 'error')
SELECT event_type, event_type = 'error' AND ts < m AS is_late, count(*) AS n FROM events, mark GROUP BY ALL
""")
def split_late(spark: SparkSession, sf: str) -> DataFrame:
    """Errors arrive after everything else: those more than a day behind are set apart."""
    source, progress = scratch_path(spark, "arrivals"), scratch_path(spark, "progress")
    on_time, late, marks = (scratch_path(spark, p) for p in ("ontime", "late", "marks"))
    log = table(spark, sf, "events")
    is_error = F.col("event_type") == "error"
    for arriving in (log.filter(~is_error), log.filter(is_error)):
        arriving.write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        runs.run_batches(stream, flows.late_splitter("ts", 86_400, on_time, late, marks), progress)
    both = spark.read.parquet(on_time).withColumn("is_late", F.lit(False)).unionByName(
        spark.read.schema(log.schema).parquet(late).withColumn("is_late", F.lit(True)), allowMissingColumns=True
    )
    return both.groupBy("event_type", "is_late").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'
""")
def current_state_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Change application from micro-batches."""
    path, progress = scratch_path(spark, "state"), scratch_path(spark, "progress")
    keys, seq = ["user_id"], ["ts", "event_id"]
    stream = _arriving_events(spark, sf).select("user_id", "event_id", "ts", "event_type", "value")
    runs.run_batches(stream, runs.scd1_writer(path, keys, seq, F.col("event_type") == "error"), progress)
    return runs.read_scd1(spark, path, keys, seq)


@query("""
SELECT event_type, count(*) AS n_rows, CAST(sum(round(value * 100)) AS BIGINT) AS total, CAST(min(round(value * 100)) AS BIGINT) AS low,
       CAST(max(round(value * 100)) AS BIGINT) AS high FROM events GROUP BY event_type
""")
def refresh_aggregate_stream(spark: SparkSession, sf: str) -> DataFrame:
    path, progress = scratch_path(spark, "partials"), scratch_path(spark, "progress")
    writer = runs.aggregate_writer(path, ["event_type"], cents("value"), F.col("user_id"))
    runs.run_batches(_arriving_events(spark, sf), writer, progress)
    return gold.serve_partials(runs.read_aggregate(spark, path, ["event_type"])).drop("reach")


def _complete(stream: DataFrame, label: str) -> DataFrame:
    """Final result of an aggregate in complete mode: each micro-batch replaces the one before."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    schema = stream.schema

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    runs.run_batches(stream, replace, scratch_path(spark, f"{label}-progress"), "complete")
    return spark.read.schema(schema).parquet(path)


@query("""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL
""")
def activity_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """In update mode behind a watermark: days that can change no more leave the state."""
    counted = audit.activity_windows(_event_stream(spark, sf), "ts", "1 day", ["event_type"], watermark="1 hour")
    return _ntz(runs.run_updates(counted, ["window_start", "window_end", "event_type"], "daily"), "window_start", "window_end")


@query("SELECT user_id, event_type, min(ts) AS first_seen FROM events GROUP BY ALL")
def first_seen_stream(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.first_seen(_event_stream(spark, sf), ["user_id", "event_type"], "ts")
    return _ntz(_complete(found, "first"), "first_seen")


@query("""
WITH m AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM m)
SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 6 HOUR AS ended, count(*) AS n FROM n GROUP BY user_id, no
""")
def session_windows_stream(spark: SparkSession, sf: str) -> DataFrame:
    found = audit.session_windows(_event_stream(spark, sf), "ts", 6 * 3600, ["user_id"])
    return _ntz(_complete(found, "sessions"), "started", "ended")


@query("""
WITH e AS (SELECT user_id, ts, event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 36 HOUR PRECEDING AND CURRENT ROW) >= 3 AS burst
           FROM events WHERE event_type = 'error'),
f AS (SELECT *, coalesce(lag(burst) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS before FROM e)
SELECT user_id, ts AS alert_at FROM f WHERE burst AND NOT before
""")
def alert_stream(spark: SparkSession, sf: str) -> DataFrame:
    found = alerts.alert_stream(_event_stream(spark, sf), "ts", F.col("event_type") == "error", 3, 36 * 3600, ["user_id"])
    return _ntz(found, "alert_at")


@query(HISTORY_SQL)
def history_stream(spark: SparkSession, sf: str) -> DataFrame:
    """History kept up to date by four micro-batches: only keys of a batch are replayed."""
    path, progress = scratch_path(spark, "changes"), scratch_path(spark, "progress")
    stream = _arriving_events(spark, sf).select("user_id", "event_type", "ts", "event_id")
    writer = runs.scd2_writer(path, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", ["event_type"])
    runs.run_batches(stream, writer, progress)
    return runs.read_history(spark, path)


@query("""
SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice / 50000) * 50000 AS DOUBLE) AS o_totalprice, sha256('s1:' || o_orderstatus) AS o_orderstatus
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 1000
""")
def secured_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Quality rule, row policy, mask and pseudonyms on a stream."""
    stream = refine.expect(table_stream(spark, sf, "orders"), {"priced": F.col("o_totalprice") > 1000}, "drop")
    seen = access.RowPolicy(frozenset({"ann"}), predicate=F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    rows = access.row_filter(stream, [seen], "ann").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    rows = access.column_mask(rows, {"o_totalprice": access.ColumnMask(masks.bucket(50_000))}, "ann")
    return runs.run_to_scratch(protection.pseudonymise(rows, ["o_orderstatus"], "s1"), "secured")


@query(f"SELECT doc_id, sha256({redacted_sql()}) AS digest FROM documents")
def redacted_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts redacted as they arrive."""
    stream = protection.redact_text(table_stream(spark, sf, "documents").select("doc_id", "text"), "text")
    return runs.run_to_scratch(stream.select("doc_id", F.sha2("text", 256).alias("digest")), "redacted")


@query(f"""
SELECT date_trunc('year', l_shipdate) AS year, count(*) AS n, CAST(sum(CAST(round(l_quantity * unit_cents) AS BIGINT)) AS BIGINT) AS cost_cents
FROM lineitem LEFT JOIN ({PRICES_SQL}) p ON l_partkey = p.partkey AND l_shipdate >= p.valid_from AND l_shipdate < p.valid_to GROUP BY ALL
""")
def priced_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Usage priced as it arrives, against the stored price list."""
    stream = table_stream(spark, sf, "lineitem").select(F.col("l_partkey").alias("partkey"), "l_quantity", "l_shipdate")
    priced = runs.run_to_scratch(cost.price_usage(stream, prices(spark, sf), ["partkey"], "l_shipdate", "l_quantity"), "priced")
    return priced.groupBy(year_of("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cost_cents").alias("cost_cents")
    )


@query("""
WITH h AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM events WHERE event_type IN ('signup', 'error'))
SELECT e.event_id, e.user_id, h.user_id IS NOT NULL AS allowed
FROM events e LEFT JOIN h ON e.user_id = h.user_id AND h.event_type = 'signup' AND e.ts >= h.valid_from AND (h.valid_to IS NULL OR e.ts < h.valid_to)
WHERE e.event_type = 'purchase'
""")
def verified_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Accesses checked as they arrive, against the stored grant history."""
    changed = table(spark, sf, "events").filter(F.col("event_type").isin("signup", "error"))
    held = changes.apply_changes_scd2(
        None, changed, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", ["event_type"]
    )
    stream = table_stream(spark, sf, "events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    checked = audit.verify_access(stream, write_through(held, "grants"), ["user_id"], "ts")
    return runs.run_to_scratch(checked.select("event_id", "user_id", "allowed"), "verified")


@query("SELECT event_type, true AS within_10_percent FROM events GROUP BY event_type")
def distinct_users_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sketches in update mode behind a watermark, joined when they are read."""
    days = audit.daily_reach(_event_stream(spark, sf), "ts", "user_id", ["event_type"], "1 hour")
    near = audit.reach_of_days(runs.run_updates(days, ["day_start", "event_type"], "reach"), ["event_type"])
    exact = audit.distinct_users(table(spark, sf, "events"), "user_id", ["event_type"]).withColumnRenamed("users", "exact")
    both = near.join(exact, "event_type")
    ok = F.abs(F.col("users") - F.col("exact")) <= 0.1 * F.col("exact")
    return both.select("event_type", ok.alias("within_10_percent"))
