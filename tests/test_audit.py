"""Sessions, bursts, as-of checks, percentiles, gaps, against brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators import audit
from tests.helpers import bag, executed_plan, ts

START = datetime(2024, 2, 28)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    rows = [
        (i, "hot" if rng.random() < 0.5 else f"u{rng.randrange(8)}", START + timedelta(minutes=30 * rng.randrange(400)), rng.randrange(50) / 4)
        for i in range(500)
    ]
    return rows, spark.createDataFrame(rows, "id bigint, u string, t timestamp_ntz, v double")


def test_payloads(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{bad"), (3, None), (4, '{"a": "no"}')], "id int, p string")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert bag(audit.parse_audit(df, "p", schema)) == {
        (1, 1, "x", None): 1, (2, None, None, "{bad"): 1, (3, None, None, None): 1, (4, None, None, '{"a": "no"}'): 1
    }


def test_window_edges(spark):
    df = spark.createDataFrame([(ts("2024-02-29T00:00:00"),), (ts("2024-02-29T23:59:59"),), (ts("2024-03-01T00:00:00"),)], "t timestamp_ntz")
    out = audit.activity_windows(df, "t", "1 day", [])
    assert bag(out, "window_start", "n") == {(ts("2024-02-29T00:00:00"), 2): 1, (ts("2024-03-01T00:00:00"), 1): 1}


def test_a_pause_of_exactly_the_gap_stays_in_the_session(spark):
    at = [0, 3600, 7201, 10801]
    df = spark.createDataFrame([(i, "u", START + timedelta(seconds=s)) for i, s in enumerate(at)], "id bigint, u string, t timestamp_ntz")
    out = audit.sessionize(df, "t", 3600, ["u"])
    assert bag(out, "id", "session_no") == {(0, 1): 1, (1, 1): 1, (2, 2): 1, (3, 2): 1}


@pytest.mark.parametrize("hot", [0, 100, 10**9])
def test_sessions_by_hand(log, hot):
    rows, df = log
    want, last = {}, {}
    for i, u, t, _ in sorted(rows, key=lambda r: (r[2], r[0])):
        no, seen = last.get(u, (0, None))
        if seen is None or t - seen > timedelta(hours=2):
            no += 1
        last[u], want[i] = (no, t), no
    got = {r["id"]: r["session_no"] for r in audit.sessionize(df, "t", 7200, ["u"], hot_rows=hot).collect()}
    assert got == want


def test_session_forms_agree(log):
    _, df = log
    native = df.groupBy(F.session_window("t", "2 hours").alias("w"), "u").agg(F.count(F.lit(1)).alias("n"))
    ours = audit.session_windows(df, "t", 7200, ["u"])
    assert bag(ours, "u", "started", "ended", "n") == bag(native, "u", "w.start", "w.end", "n")


def test_bursts_by_hand(log):
    rows, df = log
    want = {}
    for _, u, t, v in rows:
        if v < 9:
            n = sum(1 for _, u2, t2, v2 in rows if u2 == u and v2 < 9 and t - timedelta(hours=6) <= t2 <= t)
            if n >= 4:
                want[u, t] = n
    out = audit.detect_bursts(df, "t", F.col("v") < 9, 4, 6 * 3600, ["u"])
    assert {(r["u"], r["t"]): r["n_in_span"] for r in out.collect()} == want


@pytest.mark.parametrize("hot", [0, 100, 10**9])
def test_percentiles_by_hand(log, hot):
    rows, df = log
    qs = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {(r["u"], r["q"]): r["value"] for r in audit.distribution(df, "v", ["u"], qs, hot_rows=hot).collect()}
    for u in {r[1] for r in rows}:
        values = [r[3] for r in rows if r[1] == u]
        for q in qs:
            assert got[u, q] == pytest.approx(np.percentile(values, q * 100))


def test_estimates(log):
    _, df = log
    near = {(r["u"], r["q"]): r["value"] for r in audit.distribution(df, "v", ["u"], [0.5], exact=False).collect()}
    exact = {(r["u"], r["q"]): r["value"] for r in audit.distribution(df, "v", ["u"], [0.5]).collect()}
    assert all(abs(near[k] - exact[k]) <= 0.5 for k in exact)


@pytest.mark.parametrize("hot", [0, 10**9])
def test_access_at_its_time(spark, hot):
    day = [ts(f"2024-01-{d:02}T00:00:00") for d in range(1, 32)]
    grants = spark.createDataFrame([("a", day[2], day[5]), ("a", day[8], None), ("b", day[0], day[1])], "u string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    uses = [(1, "a", day[1]), (2, "a", day[2]), (3, "a", day[5]), (4, "a", day[4]), (5, "a", day[30]), (6, "b", day[1]), (7, "c", day[3])]
    log = spark.createDataFrame(uses, "id int, u string, t timestamp_ntz")
    out = audit.verify_access(log, grants, ["u"], "t", hot_rows=hot)
    assert bag(out, "id", "allowed", "granted_at") == {
        (1, False, None): 1, (2, True, day[2]): 1, (3, False, None): 1, (4, True, day[2]): 1, (5, True, day[8]): 1,
        (6, False, None): 1, (7, False, None): 1,
    }


def test_gaps_and_anomalies(spark):
    df = spark.createDataFrame([("a", ts("2024-02-28T05:00:00")), ("a", ts("2024-03-01T05:00:00")), ("b", ts("2024-02-29T05:00:00"))], "k string, t timestamp_ntz")
    full = audit.fill_gaps(df, "t", ["k"])
    assert full.count() == 6 and full.agg(F.sum("n")).first()[0] == 3
    out = audit.anomalies(full, "day", "n", ["k"], 2).filter("k = 'a'").orderBy("day").collect()
    assert [(r["mean"], r["z"]) for r in out] == [(None, None), (1.0, None), (0.5, pytest.approx(0.7071, abs=1e-3))]
    fresh = audit.freshness(df, ["k"], "t", F.lit("2024-03-01 05:00:10").cast("timestamp_ntz"))
    assert bag(fresh, "k", "silent_seconds") == {("a", 10): 1, ("b", 86410): 1}


def test_top_k_is_cut_before_the_shuffle(log):
    rows, df = log
    out = audit.top_k(df, ["u"], [F.col("v").desc(), F.col("id")], 2)
    hot = sorted(((-v, i) for i, u, _, v in rows if u == "hot"))[:2]
    assert [(r["id"], r["rank"]) for r in out.filter("u = 'hot'").orderBy("rank").collect()] == [(hot[0][1], 1), (hot[1][1], 2)]
    assert "WindowGroupLimit" in executed_plan(out)


@pytest.mark.parametrize("k", [1500, 1])
def test_top_k_of_any_size(spark, k):
    df = spark.range(6000).select("id", (F.col("id") % 2).alias("g"), F.xxhash64("id").alias("v"))
    rows = df.collect()
    out = audit.top_k(df, ["g"], [F.col("v").desc(), F.col("id")], k, 8)
    for g in (0, 1):
        want = sorted(((-r["v"], r["id"]) for r in rows if r["g"] == g))[:k]
        assert [r["id"] for r in out.filter(F.col("g") == g).orderBy("rank").collect()] == [i for _, i in want]


def test_reach(log):
    rows, df = log
    per_day = df.withColumn("d", F.col("t").cast("date"))
    assert audit.distinct_users(per_day, "u", ["d"]).agg(F.sum("users")).first()[0] == len({(u, t.date()) for _, u, t, _ in rows})
    sketches = audit.distinct_users(per_day, "u", ["d"], "sketch")
    assert sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("users"))).first()[0] == len({r[1] for r in rows})
    with pytest.raises(ValueError):
        audit.distinct_users(df, "u", [], "guess")


def test_matrix(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "z")], "r string, c string")
    assert bag(audit.access_matrix(df, ["r"], "c", ["x", "y"])) == {("a", 2, 0): 1, ("b", 0, 0): 1}


def test_silent_ranges(spark):
    """Gaps ahead, between and behind; together with the days present they are every day once."""
    rows = [("a", "2024-01-03"), ("a", "2024-01-03"), ("a", "2024-01-06"), ("b", "2024-01-01"), (None, "2024-01-10"), ("c", None)]
    log = spark.createDataFrame(rows, "u string, d string").withColumn("ts", F.col("d").cast("timestamp_ntz"))
    found = {(r["u"], str(r["first_day"]), str(r["last_day"]), r["days"]) for r in audit.silent_ranges(log, "ts", ["u"]).collect()}
    day = "2024-01-{:02d}".format
    assert found == {
        ("a", day(1), day(2), 2), ("a", day(4), day(5), 2), ("a", day(7), day(10), 4), ("b", day(2), day(10), 9), (None, day(1), day(9), 9),
    }
    part = audit.silent_ranges(log, "ts", ["u"], F.lit("2024-01-02").cast("date"), F.lit("2024-01-05").cast("date"))
    assert {(r["u"], r["days"]) for r in part.collect()} == {("a", 1), ("a", 2), ("b", 4), (None, 4)}
    filled = audit.fill_gaps(log, "ts", ["u"]).filter("n = 0 AND u = 'a'").count()
    assert filled == 2 + 2 + 4
    assert audit.silent_ranges(log.limit(0), "ts", ["u"]).count() == 0
