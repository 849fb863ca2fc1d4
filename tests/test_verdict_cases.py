"""Hand cases on NULLs, conflicts and stale policies."""

from pyspark.sql import functions as F

from terrace.functions import masks
from terrace.operators import access, audit, cost, hierarchy, layout
from terrace.operators.access import ColumnMask, RowPolicy
from terrace.sources import foreign
from tests.helpers import bag, executed_plan, ts


def decisions(spark, rows):
    return spark.createDataFrame(rows, "principal string, object string, column string, effect string, mask string")


def test_masks_outlive_dropped_columns_and_letter_case(spark):
    df = spark.createDataFrame([(1, "alice@x.y")], "id int, email string")
    privileges = spark.createDataFrame([("p", "SELECT", "t")], "principal string, privilege string, object_id string")
    stale = [("p", "t", f"gone{i}", "allow", "none") for i in range(5)]
    for name, effect, mask, seen in [
        ("email", "allow", "redact", "REDACTED"), ("Email", "allow", "redact", "REDACTED"), ("EMAIL", "DENY", "none", None),
        ("email", None, "none", None), ("email", "allow", "no such mask", None), ("email", "allow", "none", "alice@x.y"),
    ]:
        told = decisions(spark, [*stale, ("p", "t", name, effect, mask)])
        assert access.secure_view(df, "t", "p", privileges, [RowPolicy(frozenset({"p"}), predicate=F.lit(True))], told).first()["email"] == seen
    assert access.column_mask(df, {"EMAIL": ColumnMask(masks.redact())}, "p").first()["email"] == "REDACTED"


def test_policies_fail_closed(spark):
    tags = spark.createDataFrame([("t", "c", "pii")], "object string, column string, tag string")
    held = spark.createDataFrame([("p", "team", "a")], "principal string, attr string, attr_value string")
    for effect, mask, want in [("DENY", "none", "deny"), (None, "none", "deny"), ("permit", "none", "deny"), ("Allow", "none", "allow"), ("allow", "odd", "allow")]:
        rules = spark.createDataFrame([("pii", "team", "a", effect, mask)], "tag string, attr string, attr_value string, effect string, mask string")
        row = access.attribute_policies(tags, rules, held).first()
        assert row["effect"] == want and (mask != "odd" or row["mask"] == "null")


def test_a_policy_over_a_list_stays_below_a_callers_filter(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(50)], "id int, nation int")
    allowed = spark.createDataFrame([("p", 3), ("p", 4)], "principal string, value int")
    rows = access.row_filter(df, [RowPolicy(frozenset(), column="nation", mapping=allowed)], "p")
    later = rows.filter(F.when(F.col("nation").isin(3, 4), F.col("id") >= 0).otherwise(F.raise_error(F.lit("leak")).cast("boolean")))
    plan = executed_plan(later)
    assert later.count() == 14 and plan.index("raise_error") < plan.index("CollectMetrics") < plan.index("Join")


def test_digest_sees_where_a_null_is(spark):
    a = spark.createDataFrame([(1, None, "x")], "k int, a string, b string")
    b = spark.createDataFrame([(1, "x", None)], "k int, a string, b string")
    assert foreign.source_digest(a).first() != foreign.source_digest(b).first()
    assert foreign.reconcile_sources(a, b, ["k"]).count() == 1


def test_shared_cost_adds_up(spark):
    pools = spark.createDataFrame([("a", 100), ("empty", 33), ("b", -7)], "pool string, cents bigint")
    drivers = spark.createDataFrame([("a", "x", 1), ("a", "y", None), ("a", "z", 2), ("b", "x", None), ("b", "y", None)], "pool string, id string, weight int")
    out = cost.allocate_shared(pools, drivers)
    assert bag(out.groupBy("pool").agg(F.sum("cents")), "pool", "sum(cents)") == bag(pools)
    assert {(r["pool"], r["id"]): r["cents"] for r in out.collect()}["empty", None] == 33
    assert {(r["pool"], r["id"]): r["cents"] for r in out.collect()}["a", "y"] == 0


def test_rollup_keeps_nodes_outside_the_tree(spark):
    edges = spark.createDataFrame([("u", "n")], "child string, parent string")
    facts = spark.createDataFrame([("u", 10), ("lone", 5), (None, 7)], "node string, cents bigint")
    out = hierarchy.hierarchy_rollup(facts, "node", edges, {"cents": F.col("cents")})
    assert bag(out) == {("u", 10): 1, ("n", 10): 1, ("lone", 5): 1, (None, 7): 1}


def test_conflicting_rules_settle_by_name(spark):
    rules = spark.createDataFrame([("v", "w2"), ("v", "w1")], "on string, workspace string")
    assert hierarchy.tag_workspace(spark.createDataFrame([("v",)], "on string"), "on", rules).first()["workspace"] == "w1"


def test_a_null_user_is_never_granted(spark):
    log = spark.createDataFrame([(None, ts("2024-01-02T00:00:00")), ("u", ts("2024-01-02T00:00:00"))], "user string, at timestamp_ntz")
    grants = spark.createDataFrame([(u, ts("2024-01-01T00:00:00"), None) for u in (None, "u")], "user string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert {r["user"]: r["allowed"] for r in audit.verify_access(log, grants, ["user"], "at").collect()} == {None: False, "u": True}


def test_frequent_values_are_exact(spark):
    df = spark.createDataFrame([("g", i) for i in range(300)] + [("g", 7), ("g", None)], "g string, v int")
    top = audit.frequent_values(df, "v", ["g"], 2)
    assert bag(top) == {("g", 1, 7, 2): 1, ("g", 2, 0, 1): 1}


def test_top_k_takes_any_type(spark):
    df = spark.createDataFrame([("g", i, {"k": i}) for i in range(30)], "g string, v int, m map<string,int>")
    assert audit.top_k(df, ["g"], ["v"], 2000).count() == 30


def test_stats_tell_files_of_one_name_apart(spark, tmp_path):
    for part in "ab":
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / f"t/p={part}"))
    files = sorted((tmp_path / "t").glob("p=*/*.parquet"))
    files[1].rename(files[1].parent / files[0].name)
    (files[1].parent / f".{files[1].name}.crc").unlink()
    assert layout.file_stats(spark.read.parquet(str(tmp_path / "t")), ["id"]).count() == 2
