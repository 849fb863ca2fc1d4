"""Inputs derived from the given tables, each as DataFrame and as the SQL that answers use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.money import cents
from terrace.functions.times import before
from terrace.sources.tables import table


#: Day on which the older of two snapshots was taken; the newer one is the whole table.
FIRST_DAY, SECOND_DAY = "1999-01-01", "2000-01-01"


def custom(spark: SparkSession, sf: str, until: str | None = None) -> DataFrame:
    """Snapshot of the customers at a day: number of orders and highest priority over all orders so far.

    A customer whose newest order is finished has left. Without a day the whole table counts.
    """
    orders = table(spark, sf, "orders")
    if until:
        orders = orders.filter(before("o_orderdate", until))
    newest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus"))
    found = orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.min("o_orderpriority").alias("priority"), newest.alias("newest")
    )
    return found.filter("newest.o_orderstatus <> 'F'").drop("newest")


def custom_sql(until: str | None = None) -> str:
    seen = f"WHERE o_orderdate < TIMESTAMP '{until}' " if until else ""
    return (
        "SELECT o_custkey AS custkey, count(*) AS n_orders, min(o_orderpriority) AS priority "
        f"FROM orders {seen}GROUP BY o_custkey HAVING arg_max(o_orderstatus, {NEWEST_ORDER_SQL}) <> 'F'"
    )


NEWEST_ORDER_SQL = "{'day': o_orderdate, 'key': o_orderkey, 'status': o_orderstatus}"


def account_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Users below workspaces (nations) below accounts (regions) below one root."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    users = c.select(F.concat(F.lit("u"), "c_custkey").alias("child"), F.concat(F.lit("n"), "c_nationkey").alias("parent"))
    spaces = n.select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    accounts = r.select(F.concat(F.lit("r"), "r_regionkey").alias("child"), F.lit("all").alias("parent"))
    return users.unionAll(spaces).unionAll(accounts)


ACCOUNT_EDGES_SQL = """
SELECT 'u' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
UNION ALL SELECT 'r' || r_regionkey, 'all' FROM region
"""


def memberships(spark: SparkSession, sf: str) -> DataFrame:
    """Users in teams (nation and segment), teams in nations, nations in regions."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    team = F.concat(F.lit("t"), "c_nationkey", F.lit("-"), "c_mktsegment")
    users = c.select(F.concat(F.lit("u"), "c_custkey").alias("member"), team.alias("group"))
    teams = c.select(team.alias("member"), F.concat(F.lit("n"), "c_nationkey").alias("group")).distinct()
    nations = n.select(F.concat(F.lit("n"), "n_nationkey").alias("member"), F.concat(F.lit("r"), "n_regionkey").alias("group"))
    return users.unionAll(teams).unionAll(nations)


MEMBERSHIPS_SQL = """
SELECT 'u' || c_custkey AS member, 't' || c_nationkey || '-' || c_mktsegment AS grp FROM customer
UNION ALL SELECT DISTINCT 't' || c_nationkey || '-' || c_mktsegment, 'n' || c_nationkey FROM customer
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
"""


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """A price list per part, raised by five percent of the list price every year."""
    part = table(spark, sf, "part")
    years = part.select("p_partkey", "p_retailprice", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("y"))
    unit = F.round(F.col("p_retailprice") * (100 + 5 * (F.col("y") - 1995))).cast("bigint")
    return years.select(
        F.col("p_partkey").alias("partkey"),
        F.make_date("y", F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("valid_from"),
        F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("valid_to"),
        unit.alias("unit_cents"),
    )


PRICES_SQL = """
SELECT p_partkey AS partkey, make_timestamp(y, 1, 1, 0, 0, 0) AS valid_from, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS valid_to,
       CAST(round(p_retailprice * (100 + 5 * (y - 1995))) AS BIGINT) AS unit_cents
FROM part, (SELECT unnest(range(1995, 2002)) AS y)
"""


def usage(spark: SparkSession, sf: str, how: str = "inner") -> DataFrame:
    """Line items as usage of parts by users in workspaces in accounts.

    By default items of a known user in a known workspace; with ``how="left"`` every item, its tag, user, workspace
    and account NULL as far as its order, customer or nation is missing.

    Orders meet their customers first, so line items are shuffled once. Customers grow with the rows: two columns
    of a small file would otherwise go through the driver.
    """
    line, orders, c, n = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation"))
    placed = orders.join(c.hint("merge"), F.col("o_custkey") == F.col("c_custkey"), how).join(n, F.col("c_nationkey") == F.col("n_nationkey"), how)
    return line.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), how).select(
        F.col("l_partkey").alias("partkey"), F.col("l_quantity").alias("quantity"), F.col("l_shipdate").alias("used_at"),
        F.col("o_orderpriority").alias("tag"), F.col("c_custkey").alias("custkey"),
        F.col("n_nationkey").alias("workspace"), F.col("n_regionkey").alias("account"),
    )


USAGE_SQL = """
SELECT l_partkey AS partkey, l_quantity AS quantity, l_shipdate AS used_at, o_orderpriority AS tag, c_custkey AS custkey,
       n_nationkey AS workspace, n_regionkey AS account
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
"""

ALL_USAGE_SQL = """
SELECT l_partkey AS partkey, l_quantity AS quantity, l_shipdate AS used_at, o_orderpriority AS tag, c_custkey AS custkey,
       n_nationkey AS workspace, n_regionkey AS account
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
"""


def priced_usage_sql(usage_sql: str = USAGE_SQL) -> str:
    return f"""
SELECT u.*, p.unit_cents, CAST(round(u.quantity * p.unit_cents) AS BIGINT) AS cost_cents
FROM ({usage_sql}) u LEFT JOIN ({PRICES_SQL}) p
ON u.partkey = p.partkey AND u.used_at >= p.valid_from AND u.used_at < p.valid_to
"""


def access_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the address they came from."""
    addr = F.lit(10 * 2**24) + F.pmod("user_id", F.lit(8)) * 2**16 + F.pmod("event_id", F.lit(256))
    return table(spark, sf, "events").withColumn("addr", addr.cast("bigint"))


ACCESS_LOG_SQL = "SELECT *, CAST(167772160 + (user_id % 8) * 65536 + event_id % 256 AS BIGINT) AS addr FROM events"


def spending(spark: SparkSession, sf: str) -> DataFrame:
    """Events as costs in cents."""
    return table(spark, sf, "events").withColumn("cost_cents", cents("value"))


SPENDING_SQL = "SELECT *, CAST(round(value * 100) AS BIGINT) AS cost_cents FROM events"
