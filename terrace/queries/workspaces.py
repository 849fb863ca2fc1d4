"""Account tree, workspaces, catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.money import cents
from terrace.operators import hierarchy
from terrace.queries.inputs import ACCOUNT_EDGES_SQL, account_edges
from terrace.queries.registry import query
from terrace.session import scratch_path
from terrace.sources.tables import table


@query(f"""
WITH RECURSIVE edges AS ({ACCOUNT_EDGES_SQL}),
up AS (
  SELECT child AS node, parent AS ancestor, 1 AS depth, child || '>' || parent AS path FROM edges
  UNION ALL SELECT up.node, e.parent, up.depth + 1, up.path || '>' || e.parent FROM up JOIN edges e ON up.ancestor = e.child)
SELECT node, ancestor, depth, path, node = ancestor AS is_cycle FROM up
""")
def expand_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    tree = hierarchy.expand_hierarchy(account_edges(spark, sf))
    return tree.withColumn("path", F.array_join("path", ">"))


@query("""
WITH spent AS (
  SELECT c_custkey, c_nationkey, n_regionkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT 'u' || c_custkey AS node, CAST(sum(cents) AS BIGINT) AS spent_cents, count(*) AS n_orders FROM spent GROUP BY 1
UNION ALL SELECT 'n' || c_nationkey, CAST(sum(cents) AS BIGINT), count(*) FROM spent GROUP BY 1
UNION ALL SELECT 'r' || n_regionkey, CAST(sum(cents) AS BIGINT), count(*) FROM spent GROUP BY 1
UNION ALL SELECT 'all', CAST(sum(cents) AS BIGINT), count(*) FROM spent
""")
def hierarchy_rollup(spark: SparkSession, sf: str) -> DataFrame:
    facts = table(spark, sf, "orders").select(
        F.concat(F.lit("u"), "o_custkey").alias("user"), cents("o_totalprice").alias("c"), F.lit(1).cast("bigint").alias("one")
    )
    return hierarchy.hierarchy_rollup(
        facts, "user", account_edges(spark, sf), {"spent_cents": F.col("c"), "n_orders": F.col("one")}
    )


@query("""
SELECT CASE WHEN r_name = 'AFRICA' THEN '_unmapped' ELSE r_name END AS workspace, count(*) AS n_orders,
       CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS spent_cents
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def route_by_workspace(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written below one workspace per region; one region has no workspace yet."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    mapping = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).filter("r_name <> 'AFRICA'")
    mapping = mapping.select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("workspace"))
    orders = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    path = scratch_path(spark, "routed")
    hierarchy.route_by_workspace(orders.select("o_orderkey", "o_totalprice", "c_nationkey"), "c_nationkey", mapping, path)
    return spark.read.parquet(path).groupBy("workspace").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(cents("o_totalprice")).alias("spent_cents")
    )


def _bindings(spark: SparkSession, sf: str):
    """Workspaces are nations, catalogs are regions; a nation is bound to its own region, ASIA is open."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    both = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        n.select(F.col("n_name").alias("workspace")),
        r.select(F.col("r_name").alias("catalog"), (F.col("r_name") == "ASIA").alias("is_open")),
        both.select(F.col("n_name").alias("workspace"), F.col("r_name").alias("catalog")),
    )


VISIBLE_SQL = """
SELECT n_name AS workspace, r_name AS catalog FROM nation JOIN region ON n_regionkey = r_regionkey
UNION SELECT n_name, 'ASIA' FROM nation
"""


@query(VISIBLE_SQL)
def resolve_bindings(spark: SparkSession, sf: str) -> DataFrame:
    return hierarchy.resolve_bindings(*_bindings(spark, sf))


@query(f"""
SELECT cn.n_name AS workspace, r_name AS catalog, count(*) AS n_accesses
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region ON sn.n_regionkey = r_regionkey
WHERE (cn.n_name, r_name) NOT IN (SELECT (workspace, catalog) FROM ({VISIBLE_SQL}))
GROUP BY ALL
""")
def binding_violations(spark: SparkSession, sf: str) -> DataFrame:
    """A nation's customers buying from suppliers of another region's catalog."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    regions = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("workspace")
    )
    sellers = table(spark, sf, "supplier").join(regions, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("r_name").alias("catalog")
    )
    log = (
        table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    )
    return hierarchy.binding_violations(*_bindings(spark, sf), log)


@query("""
WITH use AS (
  SELECT l_partkey, max(l_shipdate) AS last_used, count(DISTINCT l_suppkey) AS n_readers, count(*) AS n_reads
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-06-30' GROUP BY l_partkey)
SELECT p_partkey AS object_id, s_name AS owner, last_used, coalesce(n_readers, 0) AS n_readers, coalesce(n_reads, 0) AS n_reads,
       coalesce(date_diff('day', last_used, TIMESTAMP '2001-06-30') > 180, true) AS is_stale, s_name IS NULL AS is_ownerless
FROM part LEFT JOIN supplier ON p_partkey = s_suppkey LEFT JOIN use ON p_partkey = l_partkey
""")
def catalog_report(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as objects read by suppliers, owned by the supplier of the same number."""
    owners = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("owner"))
    objects = table(spark, sf, "part").select(F.col("p_partkey").alias("object_id")).join(
        owners, F.col("object_id") == F.col("s_suppkey"), "left"
    )
    log = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("object_id"), F.col("l_suppkey").alias("reader"), F.col("l_shipdate").alias("at")
    )
    as_of = F.lit("2001-06-30").cast("timestamp_ntz")
    return hierarchy.catalog_report(objects.select("object_id", "owner"), log, as_of, 180, exact=True)
