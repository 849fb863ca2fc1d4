"""Cost of usage: prices, owners, allocation, budgets, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.money import cents
from terrace.functions.times import month_of, year_of
from terrace.operators import cost
from terrace.queries.inputs import ALL_USAGE_SQL, SPENDING_SQL, priced_usage_sql, prices, spending, usage
from terrace.queries.registry import query
from terrace.sources.tables import table


def priced(spark: SparkSession, sf: str, how: str = "inner") -> DataFrame:
    return cost.price_usage(usage(spark, sf, how), prices(spark, sf), ["partkey"], "used_at", "quantity")


@query(f"""
SELECT workspace, date_trunc('year', used_at) AS year, count(*) AS n, CAST(sum(cost_cents) AS BIGINT) AS cost_cents
FROM ({priced_usage_sql()}) GROUP BY ALL
""")
def price_usage(spark: SparkSession, sf: str) -> DataFrame:
    return priced(spark, sf).groupBy("workspace", year_of("used_at").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("cost_cents").alias("cost_cents")
    )


@query(f"""
SELECT workspace, count(*) AS n_unpriced, CAST(sum(quantity) AS DOUBLE) AS unpriced_quantity
FROM (SELECT u.*, CASE WHEN used_at >= TIMESTAMP '1998-01-01' THEN cost_cents END AS known FROM ({priced_usage_sql()}) u)
WHERE known IS NULL GROUP BY ALL
""")
def unpriced_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Prices listed from 1998 on only: usage before that has none."""
    late = prices(spark, sf).filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.lit("1998-01-01").cast("timestamp_ntz")))
    from_1998 = F.greatest("valid_from", F.lit("1998-01-01").cast("timestamp_ntz"))
    found = cost.price_usage(usage(spark, sf), late.withColumn("valid_from", from_1998), ["partkey"], "used_at", "quantity")
    return cost.unpriced_usage(found, ["workspace"], "quantity")


def attributed(spark: SparkSession, sf: str) -> DataFrame:
    """Urgent and high orders are owned by tag, workspaces outside AFRICA by their nation."""
    priorities = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("tag")).distinct()
    rules = priorities.filter(F.col("tag") < "3").select("tag", F.concat(F.lit("team "), "tag").alias("owner"))
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region").filter("r_name <> 'AFRICA'")
    owners = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    owners = owners.select(F.col("n_nationkey").alias("workspace"), F.col("n_name").alias("owner"))
    return cost.attribute_cost(priced(spark, sf), rules, owners)


ATTRIBUTED_SQL = f"""
SELECT u.*, coalesce(CASE WHEN tag < '3' THEN 'team ' || tag END, o.owner, 'unallocated') AS owner,
       CASE WHEN tag < '3' THEN 'tag' WHEN o.owner IS NOT NULL THEN 'workspace' ELSE 'none' END AS owner_by
FROM ({priced_usage_sql()}) u LEFT JOIN (
  SELECT n_nationkey, n_name AS owner FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA') o ON workspace = n_nationkey
"""


@query(f"""
SELECT owner, owner_by, count(*) AS n, CAST(sum(cost_cents) AS BIGINT) AS cost_cents FROM ({ATTRIBUTED_SQL}) GROUP BY ALL
""")
def attribute_cost(spark: SparkSession, sf: str) -> DataFrame:
    return attributed(spark, sf).groupBy("owner", "owner_by").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cost_cents").alias("cost_cents")
    )


@query(f"""
SELECT workspace, CAST(sum(cost_cents) AS BIGINT) AS cost_cents, count(*) AS n_rows
FROM ({ATTRIBUTED_SQL}) WHERE owner = 'unallocated' GROUP BY ALL
""")
def untagged_cost(spark: SparkSession, sf: str) -> DataFrame:
    return cost.untagged_cost(attributed(spark, sf), "workspace", "cost_cents")


@query("""
WITH d AS (SELECT event_type AS pool, user_id AS id, count(*) AS weight FROM events GROUP BY ALL),
p AS (SELECT pool, CAST(sum(weight) AS BIGINT) AS w, CASE WHEN pool <> 'error' THEN 10001 END AS cents FROM d GROUP BY pool),
s AS (SELECT d.pool, id, weight, (cents * weight - (cents * weight) % w) // w AS share, (cents * weight) % w AS rem FROM d JOIN p ON d.pool = p.pool),
r AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY rem DESC, md5(CAST(id AS VARCHAR)), id) AS rn,
             10001 - sum(share) OVER (PARTITION BY pool) AS spare FROM s)
SELECT pool, id, weight, CAST(share + CASE WHEN rn <= spare THEN 1 ELSE 0 END AS BIGINT) AS cents FROM r
""")
def allocate_shared(spark: SparkSession, sf: str) -> DataFrame:
    """100.01 per kind of event, split over its users by their events; what errors cost is not known."""
    drivers = table(spark, sf, "events").groupBy(F.col("event_type").alias("pool"), F.col("user_id").alias("id")).agg(
        F.count(F.lit(1)).alias("weight")
    )
    pools = drivers.select("pool").distinct().withColumn("cents", F.when(F.col("pool") != "error", F.lit(10_001)).cast("bigint"))
    return cost.allocate_shared(pools, drivers)


@query(f"""
SELECT coalesce(account, -1) AS account, coalesce(workspace, -1) AS workspace, CAST(grouping_id(account, workspace) AS BIGINT) AS grouping_id,
       CAST(sum(cost_cents) AS BIGINT) AS cost_cents
FROM ({priced_usage_sql(ALL_USAGE_SQL)}) GROUP BY ROLLUP (account, workspace)
""")
def cost_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Cost of all usage: what has no known account or workspace is in the totals and in a row of -1 with ``grouping_id`` 0."""
    return cost.cost_rollup(priced(spark, sf, "left"), ["account", "workspace"]).na.fill(-1, ["account", "workspace"])


BURN_SQL = f"""
SELECT user_id, ts, event_id, cost_cents, CAST(sum(cost_cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent_cents,
       CAST(round(c_acctbal * 10) AS BIGINT) AS budget_cents
FROM ({SPENDING_SQL}) JOIN customer ON user_id = c_custkey
"""


def _burn(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of a customer's balance is the budget for the events of the user of that number."""
    budgets = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.round(F.col("c_acctbal") * 10).cast("bigint").alias("budget_cents")
    )
    costs = spending(spark, sf).select("user_id", "ts", "event_id", "cost_cents")
    return cost.budget_burn(costs, budgets, "user_id", ["ts", "event_id"], "cost_cents")


@query(f"SELECT *, spent_cents > budget_cents AS breached FROM ({BURN_SQL})")
def budget_burn(spark: SparkSession, sf: str) -> DataFrame:
    return _burn(spark, sf)


@query(f"SELECT user_id, min(ts) AS first_breach FROM ({BURN_SQL}) WHERE spent_cents > budget_cents GROUP BY user_id")
def first_breach(spark: SparkSession, sf: str) -> DataFrame:
    return cost.first_breach(_burn(spark, sf), "user_id", "ts")


@query("""
WITH t AS (SELECT c_mktsegment, date_trunc('month', o_orderdate) AS period, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
months AS (SELECT c_mktsegment, unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS period FROM t GROUP BY 1),
filled AS (SELECT c_mktsegment, period, coalesce(cents, 0) AS cents FROM months LEFT JOIN t USING (c_mktsegment, period))
SELECT c_mktsegment, period, cents, cents - lag(cents, 1, cents) OVER w AS change_cents,
       round(avg(cents) OVER (PARTITION BY c_mktsegment ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_mean
FROM filled WINDOW w AS (PARTITION BY c_mktsegment ORDER BY period)
""")
def cost_trend(spark: SparkSession, sf: str) -> DataFrame:
    costs = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    costs = costs.select("c_mktsegment", "o_orderdate", cents("o_totalprice").alias("c"))
    out = cost.cost_trend(costs, month_of("o_orderdate"), ["c_mktsegment"], "c")
    return out.na.fill(0, ["change_cents"]).withColumn("moving_mean", F.round("moving_mean", 2))


@query("""
WITH t AS (SELECT c_nationkey, o_orderpriority, date_trunc('month', o_orderdate) AS period,
                  CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
ends AS (SELECT c_nationkey, o_orderpriority, min(period) AS lo, max(period) AS hi FROM t GROUP BY ALL),
months AS (SELECT c_nationkey, o_orderpriority, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS period FROM ends),
filled AS (SELECT c_nationkey, o_orderpriority, period, coalesce(cents, 0) AS cents
           FROM months LEFT JOIN t USING (c_nationkey, o_orderpriority, period))
SELECT c_nationkey, o_orderpriority, period, cents, cents - lag(cents, 1, cents) OVER w AS change_cents,
       round(avg(cents) OVER (PARTITION BY c_nationkey, o_orderpriority ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_mean
FROM filled WINDOW w AS (PARTITION BY c_nationkey, o_orderpriority ORDER BY period)
""")
def cost_trend_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Keys so fine that some months are silent."""
    costs = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    costs = costs.select("c_nationkey", "o_orderpriority", "o_orderdate", cents("o_totalprice").alias("c"))
    out = cost.cost_trend(costs, month_of("o_orderdate"), ["c_nationkey", "o_orderpriority"], "c")
    return out.na.fill(0, ["change_cents"]).withColumn("moving_mean", F.round("moving_mean", 2))


@query(f"""
WITH b AS (SELECT date_trunc('month', used_at) AS month, sum(cost_cents) AS billed FROM ({priced_usage_sql()}) GROUP BY 1),
a AS (SELECT date_trunc('month', used_at) AS month, sum(cost_cents) AS owned FROM ({ATTRIBUTED_SQL}) WHERE owner <> 'unallocated' GROUP BY 1)
SELECT b.month, CAST(billed AS BIGINT) AS billed_cents, CAST(coalesce(owned, 0) AS BIGINT) AS attributed_cents,
       CAST(billed - coalesce(owned, 0) AS BIGINT) AS gap_cents
FROM b LEFT JOIN a ON b.month = a.month WHERE billed <> coalesce(owned, 0)
""")
def reconcile_cost(spark: SparkSession, sf: str) -> DataFrame:
    """Billed cost against cost that has an owner, per month."""
    month = month_of("used_at").alias("month")
    billed = priced(spark, sf).select(month, "cost_cents")
    owned = attributed(spark, sf).filter(F.col("owner") != cost.UNALLOCATED).select(month, "cost_cents")
    return cost.reconcile_cost(billed, owned, "month", "cost_cents")
