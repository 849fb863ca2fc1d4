"""Current state, history, snapshots and feeds."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators.changes import apply_changes_scd1, apply_changes_scd2, live_rows, merge_changes
from terrace.operators.snapshots import change_feed, diff_snapshots, replay_feed
from terrace.functions.times import day_of
from tests.helpers import bag, ts

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
COLS = "k int, t timestamp_ntz, n int, op string, v string"


def rule():
    return {"keys": ["k"], "seq": ["t", "n"], "delete_when": F.col("op") == "d"}


def day(d, h=0):
    return ts(f"2024-01-{d:02}T{h:02}:00:00")


def test_state_edges(spark):
    changes = [
        (1, day(3), 0, "u", "late"), (1, day(1), 0, "u", "first"),  # out of order
        (2, day(1), 0, "u", "x"), (2, day(1), 1, "u", "y"),  # same time, tie-breaker
        (3, day(1), 0, "u", "x"), (3, day(2), 0, "d", None), (3, day(4), 0, "u", "again"),  # re-inserted
        (4, day(1), 0, "d", None),  # delete of an unknown key
        (5, day(1), 0, "u", None),  # NULL value is a value
    ]
    df = spark.createDataFrame(changes, COLS)
    out = apply_changes_scd1(None, df, **rule())
    assert {(r["k"], r["v"]) for r in out.collect()} == {(1, "late"), (2, "y"), (3, "again"), (5, None)}


def test_a_late_change_does_not_revive_a_deleted_row(spark):
    first = spark.createDataFrame([(1, day(5), 0, "d", None)], COLS)
    late = spark.createDataFrame([(1, day(2), 0, "u", "old")], COLS)
    state = merge_changes(None, first, **rule())
    assert apply_changes_scd1(state, late, **rule()).count() == 0


changes_strategy = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 9), st.sampled_from("uud"), st.sampled_from("abc")),
    min_size=1, max_size=14, unique_by=lambda c: (c[0], c[1]),
)


@FEW
@given(rows=changes_strategy, seed=st.integers(0, 99))
def test_state_ignores_order_and_replay(spark, rows, seed):
    data = [(k, day(d), 0, op, v) for k, d, op, v in rows]
    random.Random(seed).shuffle(data)
    cut = len(data) // 2
    first, second = (spark.createDataFrame(part, COLS) for part in (data[:cut], data[cut:]))
    whole = apply_changes_scd1(None, first.unionAll(second), **rule())
    state = merge_changes(None, first, **rule())
    twice = merge_changes(merge_changes(state, second, **rule()), second, **rule())
    assert bag(live_rows(twice), *whole.columns) == bag(whole)


@FEW
@given(rows=changes_strategy, seed=st.integers(0, 99), hot=st.sampled_from([0, 3, 10**9]))
def test_history_is_exact_for_late_changes(spark, rows, seed, hot):
    data = [(k, day(d), 0, op, v) for k, d, op, v in rows]
    random.Random(seed).shuffle(data)
    cut = len(data) // 2
    first, second = (spark.createDataFrame(part, COLS) for part in (data[:cut], data[cut:]))
    args = {**rule(), "track": ["v"], "chunk": day_of("t"), "hot_rows": hot}
    target = apply_changes_scd2(None, first, **args)
    got = bag(apply_changes_scd2(target, second, **args, log=first), "k", "v", "valid_from", "valid_to")
    want = []
    for k in {r[0] for r in data}:
        state = None
        for _, t, _, op, v in sorted(r for r in data if r[0] == k):
            new = None if op == "d" else v
            if new != state:
                if state is not None:
                    want[-1] = (*want[-1][:3], t)
                if new is not None:
                    want.append((k, new, t, None))
            state = new
    assert got == {w: 1 for w in want}


def test_history_without_a_log_splits_rows(spark):
    args = {**rule(), "track": ["v"], "chunk": day_of("t")}
    target = apply_changes_scd2(None, spark.createDataFrame([(1, day(1), 0, "u", "a"), (1, day(9), 0, "d", None), (2, day(1), 0, "u", "z")], COLS), **args)
    late = spark.createDataFrame([(1, day(4), 0, "u", "b")], COLS)
    out = apply_changes_scd2(target, late, **args)
    assert bag(out, "k", "v", "valid_from", "valid_to") == {
        (1, "a", day(1), day(4)): 1, (1, "b", day(4), day(9)): 1, (2, "z", day(1), None): 1
    }


def test_history_edges(spark):
    rows = [
        (1, day(1), 0, "u", "a"), (1, day(1), 1, "u", "b"), (1, day(2), 0, "u", "b"), (1, day(3), 0, "u", None),
        (1, day(4), 0, "u", None), (1, day(5), 0, "d", None), (1, day(6), 0, "d", None), (1, day(7), 0, "u", "b"),
    ]
    out = apply_changes_scd2(None, spark.createDataFrame(rows, COLS), **rule(), track=["v"], chunk=day_of("t"))
    assert bag(out, "v", "valid_from", "valid_to") == {
        ("b", day(1), day(3)): 1, (None, day(3), day(5)): 1, ("b", day(7), None): 1
    }


SNAP = "k int, a string, b int"


def test_diff(spark):
    old = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, None, 3), (None, "n", 0)], SNAP)
    new = spark.createDataFrame([(1, "x", 1), (2, "z", 2), (4, "w", 4), (None, "m", 0)], SNAP)
    out = diff_snapshots(old, new, ["k"], ["a", "b"])
    assert bag(out, "change", "k", "old_a", "new_a") == {
        ("update", 2, "y", "z"): 1, ("delete", 3, None, None): 1, ("insert", 4, None, "w"): 1, ("update", None, "n", "m"): 1
    }


snapshot = st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)), max_size=6)


@FEW
@given(states=st.lists(snapshot, min_size=3, max_size=3))
def test_replay_gives_the_new_snapshot(spark, states):
    frames = [spark.createDataFrame([(k, a, b) for k, (a, b) in s.items()], SNAP) for s in states]
    feeds = [change_feed(frames[i], frames[i + 1], ["k"], i) for i in (0, 1)]
    assert bag(replay_feed(frames[0], feeds[0], ["k"])) == bag(frames[1])
    assert bag(replay_feed(frames[0], feeds[0].unionByName(feeds[1]), ["k"])) == bag(frames[2])
    assert diff_snapshots(frames[1], frames[1], ["k"], ["a", "b"]).count() == 0


def test_column_dropped_between_versions(spark):
    old = spark.createDataFrame([(1, "x", 1)], SNAP)
    new = spark.createDataFrame([(1, "x")], "k int, a string")
    assert change_feed(old, new, ["k"], 1).count() == 0
    with pytest.raises(Exception, match="b"):
        change_feed(new, old, ["k"], 1).count()
