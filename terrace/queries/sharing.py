"""Shares, change feeds, share usage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators import sharing, snapshots
from terrace.queries.inputs import FIRST_DAY, SECOND_DAY, custom, custom_sql
from terrace.queries.registry import query
from terrace.session import scratch_path
from terrace.sources.tables import table


@query("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01'")
def build_share(spark: SparkSession, sf: str) -> DataFrame:
    recent = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return sharing.build_share(
        table(spark, sf, "orders"), ["o_orderkey", "o_orderdate", "o_totalprice"], recent & (F.col("o_orderstatus") == "F")
    )


@query("""
SELECT recipient, c_nationkey, count(*) AS n_customers, CAST(sum(c_custkey) AS BIGINT) AS key_sum
FROM customer JOIN (
  SELECT r_name AS recipient, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION SELECT DISTINCT 'suppliers of ' || s_nationkey, s_nationkey FROM supplier) ON c_nationkey = n_nationkey
GROUP BY ALL
""")
def share_by_recipient(spark: SparkSession, sf: str) -> DataFrame:
    """Customers for regional offices and for the suppliers of each nation, one write for all."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    offices = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("recipient"), F.col("n_nationkey").alias("c_nationkey")
    )
    # listed once per supplier, so most entitlements occur many times
    local = table(spark, sf, "supplier").select(
        F.concat(F.lit("suppliers of "), "s_nationkey").alias("recipient"), F.col("s_nationkey").alias("c_nationkey")
    )
    shared = sharing.share_by_recipient(table(spark, sf, "customer"), offices.unionByName(local), ["c_nationkey"])
    path = scratch_path(spark, "shares")
    sharing.write_shares(shared, path)
    return spark.read.parquet(path).groupBy("recipient", "c_nationkey").agg(
        F.count(F.lit(1)).alias("n_customers"), F.sum("c_custkey").alias("key_sum")
    )


@query(f"""
WITH o AS ({custom_sql(SECOND_DAY)}), n AS ({custom_sql()}),
j AS (SELECT o.custkey AS ok, o.n_orders AS o_n, o.priority AS op, n.custkey AS nk, n.n_orders AS n_n, n.priority AS np
      FROM o FULL JOIN n ON o.custkey = n.custkey)
SELECT nk AS custkey, n_n AS n_orders, np AS priority, 'insert' AS _change_type, CAST(7 AS BIGINT) AS _version FROM j WHERE ok IS NULL
UNION ALL SELECT ok, o_n, op, 'delete', 7 FROM j WHERE nk IS NULL
UNION ALL SELECT ok, o_n, op, 'update_preimage', 7 FROM j WHERE ok = nk AND (o_n <> n_n OR op <> np)
UNION ALL SELECT nk, n_n, np, 'update_postimage', 7 FROM j WHERE ok = nk AND (o_n <> n_n OR op <> np)
""")
def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.change_feed(custom(spark, sf, SECOND_DAY), custom(spark, sf), ["custkey"], 7)


@query(custom_sql())
def replay_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The first snapshot plus the feeds to the second and to the whole table is the whole table."""
    taken = [custom(spark, sf, day) for day in (FIRST_DAY, SECOND_DAY, None)]
    feeds = [snapshots.change_feed(taken[i], taken[i + 1], ["custkey"], i + 1) for i in (0, 1)]
    return snapshots.replay_feed(taken[0], feeds[0].unionByName(feeds[1]), ["custkey"])


@query("""
WITH granted AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag = 'N'),
red AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_returnflag IN ('R', 'A'))
SELECT 'ungranted_read' AS finding, l_suppkey, l_partkey FROM (FROM red EXCEPT FROM granted)
UNION ALL SELECT 'unused_grant', l_suppkey, l_partkey FROM (FROM granted EXCEPT FROM red)
""")
def share_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Parts a supplier delivered count as granted, parts that came back or were accepted as read."""
    line = table(spark, sf, "lineitem")
    return sharing.share_usage(
        line.filter("l_returnflag = 'N'"), line.filter("l_returnflag IN ('R', 'A')"), ["l_suppkey", "l_partkey"]
    )
