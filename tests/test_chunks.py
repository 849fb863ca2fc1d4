"""Chunked windows must equal plain windows whatever the cut, hot keys or not."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators.audit import distribution, sessionize, verify_access
from terrace.operators.changes import history_from_changes
from terrace.operators.cost import budget_burn
from terrace.functions.times import micros, time_slot
from terrace.plans.chunks import last_known, neighbour, running_total, tag_chunks, untag
from tests.helpers import bag, executed_plan


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(600):
        key = None if i % 50 == 0 else ("hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}")
        value = None if rng.random() < 0.4 else rng.randrange(100)
        at = None if i % 13 == 0 else start + timedelta(seconds=rng.randrange(20 * 86400))
        data.append((i, key, at, value))
    return spark.createDataFrame(data, "id bigint, k string, t timestamp_ntz, v bigint").cache()


@pytest.mark.parametrize("hot_rows", [0, 50, 10**9])
@pytest.mark.parametrize("width", [None, 3600, 86400 * 7])
def test_same_as_plain_windows(rows, hot_rows, width):
    order = ["t", "id"]
    tagged = tag_chunks(rows, ["k"], "t", width and time_slot("t", width), hot_rows)
    w = Window.partitionBy("k").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    out = neighbour(tagged, order, {"before": F.col("v"), "before_t": F.col("t")})
    out = neighbour(out, order, {"after": F.col("v")}, forward=True)
    out = running_total(out, order, F.coalesce("v", F.lit(0)), "total")
    out = untag(last_known(out, order, F.col("v"), "known"))
    plain = rows.select(
        "*", F.lag("v").over(w).alias("before"), F.lag("t").over(w).alias("before_t"), F.lead("v").over(w).alias("after"),
        F.sum(F.coalesce("v", F.lit(0))).over(upto).alias("total"), F.last("v", ignorenulls=True).over(upto).alias("known"),
    )
    assert bag(out, *plain.columns) == bag(plain)


def test_cold_data_takes_one_shuffle(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    order = ["ts", "event_id"]
    out = running_total(tag_chunks(events, ["user_id"], "ts"), order, F.lit(1), "n")
    out = neighbour(out, order, {"p": F.col("n")})
    final = executed_plan(out).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
    assert "Join" not in final


def test_hot_keys_are_shuffled_with_their_chunk(rows):
    order = ["t", "id"]
    out = running_total(tag_chunks(rows, ["k"], "t", None, 50), order, F.lit(1), "n")
    final = executed_plan(out).split("== Initial Plan ==")[0]
    assert "hashpartitioning(__key#" in final
    for line in final.splitlines():
        if "Window" in line and "rowsBetween" not in line:
            assert "SinglePartition" not in line
    assert "BroadcastHashJoin" in final


@pytest.mark.parametrize("key", [None, 1])
def test_operators_do_not_depend_on_the_cut(spark, key):
    """NULL keys, NULL times and NaN: cold and hot keys alike, as in plain windows."""
    at = [None, None, *[f"2024-01-{d:02d} {h:02d}:00:00" for d in range(1, 4) for h in (0, 1, 1, 9)]]
    log = spark.createDataFrame([(key, i, t, i % 3 == 0) for i, t in enumerate(at)], "k int, id int, t string, gone boolean")
    log = log.withColumn("t", F.col("t").cast("timestamp_ntz"))
    costs = log.withColumn("cents", F.lit(10).cast("bigint"))
    budgets = spark.createDataFrame([(key, 45)], "k int, budget_cents bigint")
    grants = spark.sql(
        "SELECT k, cast(f AS timestamp_ntz) AS valid_from, cast(u AS timestamp_ntz) AS valid_to FROM VALUES "
        f"({'NULL' if key is None else key}, '2024-01-01 01:00:00', '2024-01-02 01:00:00'), (1, NULL, '2023-01-01 00:00:00') AS g(k, f, u)"
    )
    values = spark.createDataFrame([(key, v) for v in (0.1, 0.25, 0.5, 3.0, float("nan"), None, 0.1)], "k int, v double")

    def all_results(hot):
        burn = budget_burn(costs, budgets, "k", ["t", "id"], "cents", hot_rows=hot)
        return [
            bag(sessionize(log, "t", 3600, ["k"], hot_rows=hot), "k", "t", "session_no"), bag(burn, "id", "spent_cents", "breached"),
            bag(history_from_changes(log, ["k"], ["t", "id"], F.col("gone"), ["id"], hot_rows=hot)),
            bag(verify_access(log, grants, ["k"], "t", hot_rows=hot), "k", "id", "allowed"),
            bag(distribution(values, "v", ["k"], [0.0, 0.5, 0.75], hot_rows=hot)),
        ]

    cold, hot = all_results(10**9), all_results(0)
    assert cold == hot
    w = Window.partitionBy("k").orderBy("t", "id")
    assert cold[1].keys() == {(i, s, s > 45 and key is not None) for i, s in costs.select("id", F.sum("cents").over(w)).collect()}
    assert (key, 0.5, 0.375) in cold[4]


def test_times(spark):
    df = spark.sql("SELECT timestamp_ntz'1970-01-02 00:00:00.000001' AS t")
    assert df.select(micros("t"), time_slot("t", 86400)).first()[:] == (86_400_000_001, 1)
