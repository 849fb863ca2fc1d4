"""Audit-log analysis over the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.times import day_of
from terrace.operators import audit, changes
from terrace.queries.registry import query
from terrace.session import write_through
from terrace.sources.tables import table


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


@query("""
SELECT event_id, user_id, event_type, CASE WHEN event_id % 97 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 97 = 0 THEN '{' || props END AS _bad_payload FROM events
""")
def parse_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every 97th payload is broken and kept as it came."""
    broken = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    log = events(spark, sf).select("event_id", "user_id", "event_type", broken.alias("props"))
    return audit.parse_audit(log, "props", T.StructType.fromDDL("k int"))


@query("""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL
""")
def activity_windows(spark: SparkSession, sf: str) -> DataFrame:
    return audit.activity_windows(events(spark, sf), "ts", "1 day", ["event_type"])


@query("""
WITH slides AS (SELECT unnest([0, 6, 12, 18]) AS h)
SELECT time_bucket(INTERVAL 6 HOUR, ts) - h * INTERVAL 1 HOUR AS window_start,
       time_bucket(INTERVAL 6 HOUR, ts) - h * INTERVAL 1 HOUR + INTERVAL 24 HOUR AS window_end, event_type, count(*) AS n
FROM events, slides GROUP BY ALL
""")
def activity_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return audit.activity_windows(events(spark, sf), "ts", "24 hours", ["event_type"], slide="6 hours")


SESSIONS_SQL = """
WITH m AS (SELECT user_id, ts, event_id, CASE WHEN ts > lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS s
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT user_id, ts, CAST(sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM m)
SELECT user_id, session_no, min(ts) AS started, max(ts) AS ended, count(*) AS n FROM n GROUP BY ALL
"""


@query(SESSIONS_SQL)
def sessionize(spark: SparkSession, sf: str) -> DataFrame:
    log = events(spark, sf).select("user_id", "ts", "event_id")
    return audit.session_totals(audit.sessionize(log, "ts", 6 * 3600, ["user_id"]), "ts", ["user_id"])


@query(f"SELECT user_id, started, ended + INTERVAL 6 HOUR AS ended, n FROM ({SESSIONS_SQL})")
def session_windows(spark: SparkSession, sf: str) -> DataFrame:
    return audit.session_windows(events(spark, sf), "ts", 6 * 3600, ["user_id"])


@query("""
WITH e AS (SELECT user_id, ts, count(*) AS n_here FROM events WHERE event_type = 'error' GROUP BY ALL),
w AS (SELECT *, CAST(sum(n_here) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 36 HOUR PRECEDING AND CURRENT ROW) AS BIGINT) AS n_in_span FROM e)
SELECT user_id, ts, n_here, n_in_span FROM w WHERE n_in_span >= 2
""")
def detect_bursts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.detect_bursts(events(spark, sf), "ts", F.col("event_type") == "error", 2, 36 * 3600, ["user_id"])


@query("SELECT user_id, event_type, min(ts) AS first_seen FROM events GROUP BY ALL")
def first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return audit.first_seen(events(spark, sf), ["user_id", "event_type"], "ts")


@query("""
SELECT event_type, event_id, user_id, value, CAST(row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS INTEGER) AS rank
FROM events QUALIFY rank <= 3
""")
def top_k(spark: SparkSession, sf: str) -> DataFrame:
    log = events(spark, sf).select("event_type", "event_id", "user_id", "value")
    return audit.top_k(log, ["event_type"], [F.col("value").desc(), F.col("event_id")], 3)


@query("""
WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)
SELECT event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS INTEGER) AS rank, user_id AS value, n
FROM c QUALIFY rank <= 3
""")
def frequent_values(spark: SparkSession, sf: str) -> DataFrame:
    """The three busiest users of each kind of event."""
    return audit.frequent_values(events(spark, sf), "user_id", ["event_type"], 3)


TYPES = ["click", "error", "purchase", "signup", "view"]


@query("SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in TYPES) + " FROM events GROUP BY user_id")
def access_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return audit.access_matrix(events(spark, sf), ["user_id"], "event_type", TYPES)


@query("SELECT event_type, date_trunc('day', ts) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    log = events(spark, sf).select("event_type", "user_id", day_of("ts").alias("day"))
    return audit.distinct_users(log, "user_id", ["event_type", "day"])


@query("""
SELECT l_returnflag, true AS approximate_within_10_percent, true AS sketch_within_10_percent FROM lineitem GROUP BY ALL
""")
def distinct_users_estimated(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct parts per return flag, estimated both ways, against the exact number."""
    line = table(spark, sf, "lineitem").select("l_returnflag", "l_partkey")
    exact = audit.distinct_users(line, "l_partkey", ["l_returnflag"])
    near = audit.distinct_users(line, "l_partkey", ["l_returnflag"], "approximate", 0.02).withColumnRenamed("users", "a")
    sketch = audit.distinct_users(line, "l_partkey", ["l_returnflag"], "sketch").select(
        "l_returnflag", F.hll_sketch_estimate("users").alias("s")
    )
    both = exact.join(near, "l_returnflag").join(sketch, "l_returnflag")
    return both.select(
        "l_returnflag",
        (F.abs(F.col("a") - F.col("users")) <= 0.1 * F.col("users")).alias("approximate_within_10_percent"),
        (F.abs(F.col("s") - F.col("users")) <= 0.1 * F.col("users")).alias("sketch_within_10_percent"),
    )


@query(" UNION ALL ".join(
    f"SELECT event_type, CAST({q} AS DOUBLE) AS q, round(quantile_cont(value, {q}), 6) AS value FROM events GROUP BY event_type"
    for q in (0.5, 0.9, 0.99)
))
def distribution(spark: SparkSession, sf: str) -> DataFrame:
    out = audit.distribution(events(spark, sf), "value", ["event_type"], [0.5, 0.9, 0.99])
    return out.withColumn("value", F.round("value", 6))


@query(" UNION ALL ".join(
    f"SELECT o_orderstatus, CAST({q} AS DOUBLE) AS q, true AS within_1_percent FROM orders GROUP BY ALL" for q in (0.25, 0.5, 0.75)
))
def distribution_estimated(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    qs = [0.25, 0.5, 0.75]
    exact = audit.distribution(orders, "o_totalprice", ["o_orderstatus"], qs)
    near = audit.distribution(orders, "o_totalprice", ["o_orderstatus"], qs, exact=False).withColumnRenamed("value", "near")
    both = exact.join(near, ["o_orderstatus", "q"])
    ok = F.abs(F.col("near") - F.col("value")) <= 0.01 * F.col("value")
    return both.select("o_orderstatus", "q", ok.alias("within_1_percent"))


@query("""
WITH h AS (
  SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM events WHERE event_type IN ('signup', 'error'))
SELECT e.event_id, e.user_id, e.ts, h.user_id IS NOT NULL AS allowed
FROM events e LEFT JOIN h ON e.user_id = h.user_id AND h.event_type = 'signup' AND e.ts >= h.valid_from AND (h.valid_to IS NULL OR e.ts < h.valid_to)
WHERE e.event_type = 'purchase'
""")
def verify_access(spark: SparkSession, sf: str) -> DataFrame:
    """Signups grant, errors revoke; was each purchase allowed at its time?"""
    log = events(spark, sf)
    changed = log.filter(F.col("event_type").isin("signup", "error")).select("user_id", "event_type", "ts", "event_id")
    held = changes.apply_changes_scd2(
        None, changed, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", ["event_type"]
    )
    held = write_through(held, "grants")  # the history is a stored table
    uses = log.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return audit.verify_access(uses, held, ["user_id"], "ts").drop("granted_at")


@query("""
WITH c AS (SELECT user_id, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL),
d AS (SELECT unnest(generate_series((SELECT min(day) FROM c), (SELECT max(day) FROM c), INTERVAL 1 DAY)) AS day),
k AS (SELECT DISTINCT user_id FROM c)
SELECT k.user_id, d.day, coalesce(c.n, 0) AS n FROM k CROSS JOIN d LEFT JOIN c ON k.user_id = c.user_id AND d.day = c.day
""")
def fill_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return audit.fill_gaps(events(spark, sf), "ts", ["user_id"])


@query("""
WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
e AS (SELECT min(day) AS low, max(day) AS high FROM d),
n AS (SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS later, row_number() OVER (PARTITION BY user_id ORDER BY day) AS place FROM d),
g AS (SELECT user_id, CAST(day + 1 AS DATE) AS first_day, CAST(coalesce(later, high + 1) - 1 AS DATE) AS last_day FROM n, e
      UNION ALL SELECT user_id, low, CAST(day - 1 AS DATE) FROM n, e WHERE place = 1)
SELECT user_id, first_day, last_day, CAST(last_day - first_day + 1 AS INTEGER) AS days FROM g WHERE first_day <= last_day
""")
def silent_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Users' runs of silent days, a row for each."""
    return audit.silent_ranges(events(spark, sf), "ts", ["user_id"])


@query("""
WITH c AS (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY ALL),
w AS (SELECT *, avg(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean,
             stddev_samp(n) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS sd FROM c)
SELECT event_type, day, n, round(mean, 6) AS mean, round(sd, 6) AS sd, CASE WHEN sd > 0 THEN round((n - mean) / sd, 6) END AS z FROM w
""")
def anomalies(spark: SparkSession, sf: str) -> DataFrame:
    daily = audit.fill_gaps(events(spark, sf), "ts", ["event_type"])
    out = audit.anomalies(daily, "day", "n", ["event_type"], 7)
    return out.select("event_type", "day", "n", *[F.round(c, 6).alias(c) for c in ("mean", "sd", "z")])


@query("""
SELECT user_id, max(ts) AS last_seen, CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 1000000) AS BIGINT) AS silent_seconds
FROM events GROUP BY user_id
""")
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return audit.freshness(events(spark, sf), ["user_id"], "ts", F.lit("2024-02-01").cast("timestamp_ntz"))
