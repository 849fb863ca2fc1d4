"""Prices, owners, allocation, budgets."""

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.functions.times import month_of
from terrace.operators import cost
from terrace.queries import ORACLES, QUERIES
from terrace.queries.inputs import usage
from tests.compare import mismatch
from tests.helpers import bag, executed_plan, ts

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
PRICES = "sku string, valid_from timestamp_ntz, valid_to timestamp_ntz, unit_cents bigint"
D1, D2, D3 = (ts(f"2024-0{m}-01T00:00:00") for m in (1, 2, 3))


def test_price_in_force(spark):
    prices = spark.createDataFrame([("a", D1, D2, 10), ("a", D2, None, 20), ("b", D2, D3, 5)], PRICES)
    rows = [
        (1, "a", ts("2023-12-31T23:59:59"), 1.0), (2, "a", D1, 1.0), (3, "a", D2, 2.0),  # before, at the start, at the change
        (4, "b", D3, 1.0), (5, "c", D2, 1.0), (6, "a", ts("2030-02-28T00:00:00"), 0.5),
    ]
    use = spark.createDataFrame(rows, "id int, sku string, at timestamp_ntz, q double")
    out = cost.price_usage(use, prices, ["sku"], "at", "q")
    assert bag(out, "id", "cost_cents") == {(1, None): 1, (2, 10): 1, (3, 40): 1, (4, None): 1, (5, None): 1, (6, 10): 1}
    assert "NestedLoop" not in executed_plan(out) and "Cartesian" not in executed_plan(out)


def test_overlapping_prices_are_refused(spark):
    use = spark.createDataFrame([(1, "a", D1, 1.0)], "id int, sku string, at timestamp_ntz, q double")
    for rows in ([("a", D1, D3, 1), ("a", D2, None, 2)], [("a", D1, None, 1), ("a", D2, D3, 2)]):
        with pytest.raises(ValueError, match="overlap"):
            cost.price_usage(use, spark.createDataFrame(rows, PRICES), ["sku"], "at", "q")


def test_owner(spark):
    costs = spark.createDataFrame([(1, "x", "w1"), (2, None, "w1"), (3, "y", "w2"), (4, None, None)], "id int, tag string, workspace string")
    rules = spark.createDataFrame([("x", "team x"), ("x", "team x")], "tag string, owner string")
    owners = spark.createDataFrame([("w1", "ann")], "workspace string, owner string")
    out = cost.attribute_cost(costs, rules, owners)
    assert bag(out, "id", "owner", "owner_by") == {
        (1, "team x", "tag"): 1, (2, "ann", "workspace"): 1, (3, "unallocated", "none"): 1, (4, "unallocated", "none"): 1
    }


def by_hand(cents, weights):
    """Largest remainder with ties settled by md5 of the id."""
    from hashlib import md5

    total = sum(weights.values())
    if total == 0:
        weights, total = dict.fromkeys(weights, 1), len(weights)
    sign, cents = (-1 if cents < 0 else 1), abs(cents)
    share = {i: cents * w // total for i, w in weights.items()}
    order = sorted(weights, key=lambda i: (-(cents * weights[i] % total), md5(str(i).encode()).hexdigest(), i))
    for i in order[: cents - sum(share.values())]:
        share[i] += 1
    return {i: sign * c for i, c in share.items()}


@FEW
@given(
    pools=st.dictionaries(st.sampled_from("pqr"), st.tuples(st.integers(-500, 10**6), st.lists(st.integers(0, 9), min_size=1, max_size=40)), min_size=1),
    slots=st.sampled_from([1, 4, 1024]), hot=st.sampled_from([0, 10, 10**9]),
)
def test_allocation_is_whole_and_exact(spark, pools, slots, hot):
    money = spark.createDataFrame([(p, c) for p, (c, _) in pools.items()], "pool string, cents bigint")
    drivers = spark.createDataFrame([(p, i, w) for p, (_, ws) in pools.items() for i, w in enumerate(ws)], "pool string, id bigint, weight bigint")
    got = {(r["pool"], r["id"]): r["cents"] for r in cost.allocate_shared(money, drivers, slots, hot).collect()}
    for p, (c, ws) in pools.items():
        assert {i: got[p, i] for i in range(len(ws))} == by_hand(c, dict(enumerate(ws)))


def test_allocation_of_a_large_pool(spark):
    drivers = spark.range(20_000).select(F.lit("p").alias("pool"), "id", F.lit(1).cast("bigint").alias("weight"))
    money = spark.createDataFrame([("p", 30_001)], "pool string, cents bigint")
    out = cost.allocate_shared(money, drivers, 1024, 100)
    assert out.agg(F.sum("cents"), F.min("cents"), F.max("cents"), F.count(F.lit(1))).first()[:] == (30_001, 1, 2, 20_000)


def test_allocation_beyond_64_bits(spark):
    weights = {i: 10**12 + i * 7 for i in range(30)}
    money = spark.createDataFrame([("p", 10**12 + 1)], "pool string, cents bigint")
    drivers = spark.createDataFrame([("p", i, w) for i, w in weights.items()], "pool string, id bigint, weight bigint")
    assert {r["id"]: r["cents"] for r in cost.allocate_shared(money, drivers).collect()} == by_hand(10**12 + 1, weights)


@pytest.mark.parametrize("hot", [0, 10**9])
def test_budget(spark, hot):
    rows = [("a", D1, 1, 40), ("a", D2, 2, 60), ("a", D2, 3, 1), ("a", D3, 4, -50), ("b", D1, 5, 999), ("c", D1, 6, 7)]
    costs = spark.createDataFrame(rows, "team string, at timestamp_ntz, id int, cents bigint")
    budgets = spark.createDataFrame([("a", 100), ("b", 999)], "team string, budget_cents bigint")
    burn = cost.budget_burn(costs, budgets, "team", ["at", "id"], "cents", hot_rows=hot)
    assert bag(burn, "id", "spent_cents", "breached") == {
        (1, 40, False): 1, (2, 100, False): 1, (3, 101, True): 1, (4, 51, False): 1, (5, 999, False): 1, (6, 7, False): 1
    }
    assert bag(cost.first_breach(burn, "team", "at")) == {("a", D2): 1}


def test_trend_and_reconciliation(spark):
    rows = [("a", ts("2024-01-31T23:59:59"), 10), ("a", ts("2024-02-29T00:00:00"), 30), ("a", D3, 20)]
    costs = spark.createDataFrame(rows, "k string, at timestamp_ntz, cents bigint")
    trend = cost.cost_trend(costs, month_of("at"), ["k"], "cents", 2)
    assert bag(trend, "period", "cents", "change_cents", "moving_mean") == {
        (D1, 10, None, 10.0): 1, (D2, 30, 20, 20.0): 1, (D3, 20, -10, 25.0): 1
    }
    gap = spark.createDataFrame(
        [("a", D1, 10), ("a", ts("2024-04-05T00:00:00"), 30), ("a", None, 5), ("b", D2, 1)], "k string, at timestamp_ntz, cents bigint"
    )
    trend = cost.cost_trend(gap, month_of("at"), ["k"], "cents", 2)
    assert bag(trend, "k", "period", "cents", "change_cents", "moving_mean") == {
        ("a", None, 5, None, 5.0): 1, ("a", D1, 10, None, 10.0): 1, ("a", D2, 0, -10, 5.0): 1, ("a", D3, 0, 0, 0.0): 1,
        ("a", ts("2024-04-01T00:00:00"), 30, 30, 15.0): 1, ("b", D2, 1, None, 1.0): 1,
    }
    billed = costs.select(month_of("at").alias("m"), "cents")
    assert cost.reconcile_cost(billed, billed, "m", "cents").count() == 0
    gaps = cost.reconcile_cost(billed, billed.filter(F.col("m") != D2), "m", "cents")
    assert bag(gaps) == {(D2, 30, 0, 30): 1}


def test_a_pool_of_unknown_cents_keeps_its_drivers(spark):
    pools = spark.createDataFrame([("a", 10), ("b", None), ("c", None)], "pool string, cents long")
    drivers = spark.createDataFrame([("a", 1, 1), ("a", 2, 1), ("b", 3, 1), ("b", 4, None)], "pool string, id int, weight int")
    found = bag(cost.allocate_shared(pools, drivers), "pool", "id", "weight", "cents")
    assert found == {("a", 1, 1, 5): 1, ("a", 2, 1, 5): 1, ("b", 3, 1, None): 1, ("b", 4, None, None): 1, ("c", None, None, None): 1}


def test_usage_without_a_price_is_counted(spark):
    priced = spark.createDataFrame([("w", 2.0, 4), ("w", 3.0, None), ("w", None, None), ("v", 1.0, 1)], "ws string, q double, cost_cents long")
    assert bag(cost.unpriced_usage(priced, ["ws"], "q")) == {("w", 2, 3.0): 1}


def test_price_lists_are_not_broadcast(spark):
    """A list made of few columns of a small file may be long: Spark's guess of its size must not send it to the driver."""
    prices = spark.range(50).select(F.col("id").cast("string").alias("sku"), F.explode(F.sequence(F.lit(1), F.lit(9))).alias("m"))
    first = F.make_date(F.lit(2024), "m", F.lit(1)).cast("timestamp_ntz")
    until = F.make_date(F.lit(2024), F.col("m") + 1, F.lit(1)).cast("timestamp_ntz")
    prices = prices.select("sku", first.alias("valid_from"), until.alias("valid_to"), (F.col("m") * 10).cast("bigint").alias("unit_cents"))
    use = spark.createDataFrame([(1, "7", D2, 1.0), (2, "99", D2, 1.0), (3, None, D2, 1.0)], "id int, sku string, at timestamp_ntz, q double")
    out = cost.price_usage(use, prices, ["sku"], "at", "q")
    assert bag(out, "id", "cost_cents") == {(1, 20): 1, (2, None): 1, (3, None): 1}
    plan = executed_plan(out)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_customers_of_usage_are_not_broadcast(spark, tmp_path):
    """Customers grow with the rows; keys that come twice or are missing join as in the SQL."""
    tables = {
        "lineitem": ([(1, 7, 2.0, D1), (1, 8, 1.0, D2), (2, 7, 3.0, D1), (3, 7, 1.0, D1), (None, 7, 1.0, D1)], "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp_ntz"),
        "orders": ([(1, 10, "1-URGENT"), (2, 11, None), (2, 11, None), (3, None, "x"), (4, 10, "y")], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "customer": ([(10, 5), (10, 6), (11, 5), (12, None), (None, 5)], "c_custkey long, c_nationkey int"),
        "nation": ([(5, 1), (6, 2)], "n_nationkey int, n_regionkey int"),
    }
    for name, (rows, columns) in tables.items():
        spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{name}.parquet")
    out = usage(spark, str(tmp_path))
    first, second = (7, 2.0, D1, "1-URGENT", 10), (8, 1.0, D2, "1-URGENT", 10)
    assert bag(out) == {(*first, 5, 1): 1, (*first, 6, 2): 1, (*second, 5, 1): 1, (*second, 6, 2): 1, (7, 3.0, D1, None, 11, 5, 1): 2}
    joins = [line for line in executed_plan(out).splitlines() if "Join" in line and "o_custkey" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_rollup_has_the_cost_of_all_usage(spark, tmp_path):
    """Items without an order, of an order without a customer and of a customer without a nation are in the totals."""
    day, con = ts("1996-05-01T00:00:00"), duckdb.connect()
    tables = {
        "lineitem": ([(k, 7, 1.0, day) for k in (1, 2, 3, 4, 5, None)] + [(1, 9, 1.0, day)], "l_orderkey long, l_partkey long, l_quantity double, l_shipdate timestamp_ntz"),
        "orders": ([(1, 10, "x"), (2, 11, "x"), (3, 99, "x"), (4, None, "x")], "o_orderkey long, o_custkey long, o_orderpriority string"),
        "customer": ([(10, 5), (11, None)], "c_custkey long, c_nationkey int"),
        "nation": ([(5, 1)], "n_nationkey int, n_regionkey int"),
        "part": ([(7, 2.0)], "p_partkey long, p_retailprice double"),
    }
    for name, (rows, columns) in tables.items():
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    out = QUERIES["cost_rollup"](spark, str(tmp_path))
    assert bag(out, "account", "workspace", "grouping_id", "cost_cents") == {
        (1, 5, 0, 210): 1, (1, -1, 1, 210): 1, (-1, -1, 0, 1050): 1, (-1, -1, 1, 1050): 1, (-1, -1, 3, 1260): 1
    }
    assert mismatch(out, con, ORACLES["cost_rollup"]) is None
    joins = [line for line in executed_plan(out).splitlines() if "Join" in line and "o_custkey" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)
