"""Rows, columns, policies, privileges: what must not be seen is not seen."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.functions import masks
from terrace.operators import access
from terrace.operators.access import ColumnMask, RowPolicy
from tests.helpers import bag, ts

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "Ann", 3, 10.0), (2, "Bob", 3, 20.0), (3, "Cyd", 4, 30.0), (4, "Dee", None, 40.0)]
    return spark.createDataFrame(rows, "id int, name string, nation int, pay double")


def mapping(spark, rows):
    return spark.createDataFrame(rows, "principal string, value int")


def test_unknown_principal_sees_nothing(spark, people):
    rules = [RowPolicy(frozenset({"a"}), predicate=F.col("nation") == 3), RowPolicy(frozenset(), column="nation", mapping=mapping(spark, [("a", 4)]))]
    assert access.row_filter(people, rules, "b").count() == 0
    assert access.row_filter(people, [], "a").count() == 0
    assert bag(access.row_filter(people, rules, "a"), "id") == {(1,): 1, (2,): 1, (3,): 1}


def test_a_callers_filter_never_meets_hidden_rows(spark, people):
    rules = [RowPolicy(frozenset(), column="nation", mapping=mapping(spark, [("a", 3), ("a", None), ("b", 4)]))]
    mine = access.row_filter(people, rules, "a")
    trap = F.when(F.col("nation") == 3, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("leak "), "name")).cast("boolean"))
    assert mine.filter(trap).count() == 2
    spy = F.udf(lambda n: n in ("Ann", "Bob") or 1 / 0 > 0, "boolean")
    assert mine.filter(spy("name")).count() == 2


def test_masks(spark):
    df = spark.createDataFrame(
        [("Abc-9", 1234.5, ts("2024-02-29T10:00:00"), 7), (None, None, None, None), ("ab", -1.0, ts("2023-12-31T23:59:59"), 0)],
        "s string, d double, t timestamp_ntz, i int",
    )
    out = df.select(
        masks.partial(3)(F.col("s"), df.schema["s"].dataType), masks.letters()(F.col("s"), None),
        masks.bucket(1000)(F.col("d"), df.schema["d"].dataType), masks.year_only()(F.col("t"), df.schema["t"].dataType),
        masks.redact()(F.col("i"), df.schema["i"].dataType), masks.redact()(F.col("s"), df.schema["s"].dataType),
        masks.redact()(F.col("t"), df.schema["t"].dataType), masks.null()(F.col("i"), df.schema["i"].dataType),
    )
    assert [tuple(r) for r in out.collect()] == [
        ("**c-9", "Xxx-n", 1000.0, ts("2024-01-01T00:00:00"), 0, "REDACTED", None, None),
        (None, None, None, None, None, None, None, None),
        ("**", "xx", -1000.0, ts("2023-01-01T00:00:00"), 0, "REDACTED", None, None),
    ]


def test_column_mask_keeps_names_types_and_order(people):
    rules = {"pay": ColumnMask(masks.bucket(100), frozenset({"boss"})), "name": ColumnMask(masks.hashed("x"))}
    out = access.column_mask(people, rules, "clerk")
    assert out.dtypes == people.dtypes
    assert {r["pay"] for r in out.collect()} == {0.0}
    assert {r["pay"] for r in access.column_mask(people, rules, "boss").collect()} == {10.0, 20.0, 30.0, 40.0}
    assert not {r["name"] for r in out.collect()} & {"Ann", "Bob", "Cyd", "Dee"}


TAGS = [("t", "c1", "pii"), ("t", "c1", "money"), ("t", "c2", "money"), ("t", "c3", "free")]


def decide(spark, policies, attrs):
    tags = spark.createDataFrame(TAGS, "object string, column string, tag string")
    p = spark.createDataFrame(policies, "tag string, attr string, attr_value string, effect string, mask string")
    a = spark.createDataFrame(attrs, "principal string, attr string, attr_value string")
    return tags, p, access.attribute_policies(tags, p, a)


def test_deny_beats_allow_and_the_stricter_mask_wins(spark):
    policies = [
        ("pii", "team", "x", "allow", "hash"), ("money", "team", "x", "allow", "bucket"), ("money", "level", "low", "deny", "null"),
        ("pii", "team", None, "allow", "none"),
    ]
    attrs = [("ann", "team", "x"), ("bob", "team", "x"), ("bob", "level", "low"), ("cyd", "team", None), ("dee", "level", None)]
    tags, p, out = decide(spark, policies, attrs)
    assert bag(out, "principal", "column", "effect", "mask") == {
        ("ann", "c1", "allow", "hash"): 1, ("ann", "c2", "allow", "bucket"): 1,
        ("bob", "c1", "deny", "null"): 1, ("bob", "c2", "deny", "null"): 1,
    }
    assert bag(access.policy_coverage(tags, p)) == {("t", "c3"): 1}


def test_no_policies(spark):
    tags, p, out = decide(spark, [("none", "a", "b", "allow", "none")], [("ann", "a", "b")])
    assert out.count() == 0
    assert access.policy_coverage(tags, p).count() == 3


def privileges(spark, grants, members=(("u", "g"), ("g", "h"), ("h", "g")), tree=(("t1", "s"), ("t2", "s"), ("s", "c"), ("lost", None))):
    return access.effective_privileges(
        spark.createDataFrame(list(grants), "principal string, privilege string, object_id string"),
        spark.createDataFrame(list(members), "member string, group string"),
        spark.createDataFrame(list(tree), "object_id string, parent_id string"),
    )


def test_privileges_go_through_groups_and_down_the_tree(spark):
    out = bag(privileges(spark, [("h", "SELECT", "s"), ("u", "MODIFY", "t2"), ("v", "SELECT", "lost")]))
    below = {(p, "SELECT", o): 1 for p in ("u", "g", "h") for o in ("s", "t1", "t2")}
    assert out == {**below, ("u", "MODIFY", "t2"): 1, ("v", "SELECT", "lost"): 1}


@FEW
@given(
    grants=st.sets(st.tuples(st.sampled_from("ugh"), st.just("SELECT"), st.sampled_from(["t1", "s", "c"])), min_size=1, max_size=5),
    more=st.tuples(st.sampled_from("ugh"), st.just("SELECT"), st.sampled_from(["t1", "s", "c"])),
)
def test_more_grants_never_take_away(spark, grants, more):
    assert set(bag(privileges(spark, grants))) <= set(bag(privileges(spark, grants | {more})))


def test_secured_view(spark, people):
    grants = [("readers", "SELECT", "hr")]
    members, tree = [("ann", "readers"), ("cyd", "readers")], [("people", "hr")]
    tags = spark.createDataFrame([("people", "pay", "money"), ("people", "name", "pii")], "object string, column string, tag string")
    policies = spark.createDataFrame(
        [("money", "role", "clerk", "allow", "bucket"), ("pii", "role", "clerk", "deny", "none")],
        "tag string, attr string, attr_value string, effect string, mask string",
    )
    attrs = spark.createDataFrame([("ann", "role", "clerk"), ("bob", "role", "clerk")], "principal string, attr string, attr_value string")
    decisions = access.attribute_policies(tags, policies, attrs)
    # the filter sees raw pay although the caller gets it masked
    rules = [RowPolicy(frozenset({"ann", "bob"}), predicate=F.col("pay") >= 20)]

    def view(who):
        held = privileges(spark, grants, members, tree)
        return access.secure_view(people, "people", who, held, rules, decisions, {"pay": {"width": 100}})

    assert bag(view("ann")) == {(2, None, 3, 0.0): 1, (3, None, 4, 0.0): 1, (4, None, None, 0.0): 1}
    assert view("bob").count() == 0  # attributes and row policy, but no privilege
    assert view("cyd").count() == 0  # privilege, but no row policy
    assert view("nobody").count() == 0


def test_access_on_demand_equals_all_privileges(spark):
    """Requests are answered as by the full list, through groups, cycles and trees; a NULL is never allowed."""
    grants = spark.createDataFrame([("g3", "SELECT", "top"), ("g1", "MODIFY", "t2"), ("u9", "SELECT", "t1"), (None, "SELECT", "t1")], "principal string, privilege string, object_id string")
    members = spark.createDataFrame([("u1", "g1"), ("g1", "g2"), ("g2", "g3"), ("g3", "g1"), ("u2", "g2"), ("u3", None)], "member string, group string")
    tree = spark.createDataFrame([("t1", "s"), ("t2", "s"), ("s", "top"), ("t3", None)], "object_id string, parent_id string")
    names, objects = ["u1", "u2", "u3", "u9", "g1", None], ["t1", "t2", "t3", "s", "top", None]
    asked = spark.createDataFrame([(n, p, o) for n in names for p in ("SELECT", "MODIFY") for o in objects] * 2, "principal string, privilege string, object_id string")
    full = {(r["principal"], r["privilege"], r["object_id"]) for r in access.effective_privileges(grants, members, tree).collect()}
    found = access.check_access(asked, access.Privileges(grants, members, tree)).collect()
    assert len(found) == 72
    for r in found:
        key = (r["principal"], r["privilege"], r["object_id"])
        assert r["allowed"] == (None not in key and key in full), key
    assert sum(r["allowed"] for r in found) > 10


def test_view_of_a_group_member_builds_no_closure(spark, people, monkeypatch):
    """Privilege, row policy and exemption are the group's; nobody else's groups are followed."""
    monkeypatch.setattr(access, "transitive_closure", lambda *a, **k: pytest.fail("closure"))
    grants = spark.createDataFrame([("staff", "SELECT", "db")], "principal string, privilege string, object_id string")
    members = spark.createDataFrame([("ann", "hr"), ("hr", "staff"), ("bob", "ops")], "member string, group string")
    tree = spark.createDataFrame([("people", "db")], "object_id string, parent_id string")
    rights = access.Privileges(grants, members, tree)
    none = spark.createDataFrame([], "principal string, object string, column string, effect string, mask string")
    rules = [RowPolicy(frozenset({"hr"}), predicate=F.col("nation") == 3), RowPolicy(frozenset(), column="nation", mapping=mapping(spark, [("staff", 4), ("ops", 3)]))]
    assert bag(access.secure_view(people, "people", "ann", rights, rules, none), "id") == {(1,): 1, (2,): 1, (3,): 1}
    assert access.secure_view(people, "people", "bob", rights, rules, none).count() == 0
    names = access.names_of("ann", members)
    assert names == {"ann", "hr", "staff"}
    hidden = access.column_mask(people, {"pay": ColumnMask(masks.null(), frozenset({"staff"}))}, names)
    assert bag(hidden, "pay") == bag(people, "pay")


def test_coverage_reads_policies_as_they_are_applied(spark):
    tags = spark.createDataFrame([("t", c, c) for c in "abcdefg"], "object string, column string, tag string")
    rules = [("a", "DENY", "none"), ("b", None, "none"), ("c", "allow", None), ("d", "Allow", "none"), ("e", "allow", "hash"), ("f", "allow", "what")]
    policies = spark.createDataFrame([(t, "x", "y", e, m) for t, e, m in rules], "tag string, attr string, attr_value string, effect string, mask string")
    assert bag(access.policy_coverage(tags, policies), "column") == {("d",): 1, ("g",): 1}
