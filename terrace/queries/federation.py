"""Several sources read as one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.money import cents
from terrace.queries.registry import query
from terrace.session import scratch_path
from terrace.sources import foreign
from terrace.sources.tables import table


@query("""
SELECT c_mktsegment, count(*) AS n, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS balance_cents
FROM customer WHERE c_acctbal > 1000 GROUP BY ALL
""")
def read_foreign(spark: SparkSession, sf: str) -> DataFrame:
    """A table of a registered catalog, filtered and aggregated in place."""
    name = "ext_" + scratch_path(spark, "x").rsplit("-", 1)[1]
    spark.catalog.createTable(name, path=f"{sf}/customer.parquet", source="parquet")
    remote = foreign.read_foreign(spark, "spark_catalog", spark.catalog.currentDatabase(), name)
    return remote.filter(F.col("c_acctbal") > 1000).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("c_acctbal")).alias("balance_cents")
    )


@query("""
SELECT n_name, count(*) AS n, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS balance_cents
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE r_name = 'ASIA' GROUP BY ALL
""")
def join_federated(spark: SparkSession, sf: str) -> DataFrame:
    """Few local nations shrink the remote customers to their keys before the join."""
    local = table(spark, sf, "nation").join(
        table(spark, sf, "region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    local = local.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    remote = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "nationkey")
    return foreign.join_federated(local, remote, "nationkey").groupBy("n_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents("c_acctbal")).alias("balance_cents")
    )


@query("""
SELECT 'crm' AS _source, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'erp', s_suppkey, s_name, NULL FROM supplier
""")
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    crm = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    erp = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return foreign.union_sources({"crm": crm, "erp": erp})


@query("""
WITH lake AS (
  SELECT l_orderkey AS orderkey, CASE WHEN min(l_linestatus) <> max(l_linestatus) THEN 'P' ELSE min(l_linestatus) END AS status
  FROM lineitem GROUP BY l_orderkey)
SELECT CASE WHEN lake.orderkey IS NULL THEN 'insert' ELSE 'update' END AS change, o_orderkey AS orderkey,
       lake.status AS old_status, o_orderstatus AS new_status
FROM orders LEFT JOIN lake ON o_orderkey = lake.orderkey
WHERE lake.orderkey IS NULL OR lake.status <> o_orderstatus
""")
def reconcile_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Order status derived in the lake against the status the source reports."""
    low, high = F.min("l_linestatus"), F.max("l_linestatus")
    lake = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.when(low != high, "P").otherwise(low).alias("status")
    )
    source = table(spark, sf, "orders").select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"))
    return foreign.reconcile_sources(lake, source, ["orderkey"])


@query("""
WITH m AS (SELECT max(o_orderdate) AS mark FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT o_orderpriority, count(*) AS n, max(o_orderdate) AS newest FROM orders, m
WHERE o_orderdate > mark OR (o_orderdate = mark AND o_orderkey % 2 = 1) GROUP BY ALL
""")
def pull_increment(spark: SparkSession, sf: str) -> DataFrame:
    """What came after the stored mark of an earlier pull, at which half of the mark's own day was still missing."""
    remote, marks = table(spark, sf, "orders"), scratch_path(spark, "marks")
    early = remote.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    foreign.store_mark(early, "o_orderdate", marks)
    mark = foreign.stored_mark(spark, marks)
    pulled = early.filter((F.col("o_orderdate") < F.lit(mark).cast("timestamp_ntz")) | (F.col("o_orderkey") % 2 == 0))
    fresh = foreign.pull_increment(remote, "o_orderdate", mark, pulled, ["o_orderkey"])
    return fresh.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("newest"))
