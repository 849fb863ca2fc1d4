"""Graph rounds: cycles, diamonds, long chains, shared keys."""

from pyspark.sql import functions as F

from terrace.operators.hierarchy import expand_hierarchy, hierarchy_rollup
from terrace.operators.identity import group_closure, match_identities, normal_text
from terrace.plans.closure import components
from tests.helpers import bag


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "child string, parent string")


def test_diamond_self_loop_and_two_roots(spark):
    out = expand_hierarchy(edges(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("x", "x"), ("y", None)]))
    got = {(r["node"], r["ancestor"]): (r["depth"], tuple(r["path"]), r["is_cycle"]) for r in out.collect()}
    assert got == {
        ("a", "b"): (1, ("a", "b"), False), ("a", "c"): (1, ("a", "c"), False), ("b", "d"): (1, ("b", "d"), False),
        ("c", "d"): (1, ("c", "d"), False), ("a", "d"): (2, ("a", "b", "d"), False), ("x", "x"): (1, ("x", "x"), True),
    }


def test_two_cycle_reports_both_nodes(spark):
    out = expand_hierarchy(edges(spark, [("a", "b"), ("b", "a"), ("z", "a")]))
    assert {r["node"] for r in out.filter("is_cycle").collect()} == {"a", "b"}
    assert ("z", "b", 2) in {(r["node"], r["ancestor"], r["depth"]) for r in out.collect()}


def test_long_chain(spark):
    out = group_closure(spark.createDataFrame([(f"{i:03}", f"{i + 1:03}") for i in range(150)], "member string, group string"))
    assert out.count() == 150 * 151 // 2
    assert out.agg(F.max("depth")).first()[0] == 150
    assert out.filter("member = '000' and group = '150'").first()["depth"] == 150


def test_rollup_counts_a_diamond_once(spark):
    facts = spark.createDataFrame([("a", 5), ("a", 2), ("b", 1)], "n string, v bigint")
    out = hierarchy_rollup(facts, "n", edges(spark, [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")]), {"v": F.col("v")})
    assert bag(out, "node", "v") == {("a", 7): 1, ("b", 8): 1, ("c", 7): 1, ("d", 8): 1}


def test_components_of_a_shuffled_chain(spark):
    pairs = [(f"i{i:02}", f"k{(i * 7) % 40}") for i in range(40)] + [(f"i{i:02}", f"k{(i * 7 + 7) % 40}") for i in range(39)]
    out = components(spark.createDataFrame(pairs, "i string, k string"), "i", "k")
    assert {r["label"] for r in out.collect()} == {"i00"} and out.count() == 40


def test_identities(spark):
    rows = [
        ("hr", "1", " Ann@X.org ", "1"), ("crm", "7", "ann@x.ORG", None), ("crm", "8", "", "9"),
        ("idp", "a", None, "9"), ("crm", "9", "bob@x.org", "9"), ("hr", "2", None, None),
    ]
    df = spark.createDataFrame(rows, "source string, record_id string, mail string, phone string")
    out = match_identities(df, {"mail": normal_text("mail"), "phone": F.col("phone")})
    got = {(r["source"], r["record_id"]): (f"{r['canonical_source']}/{r['canonical_record_id']}", r["is_ambiguous"]) for r in out.collect()}
    assert got == {
        ("hr", "1"): ("crm/7", False), ("crm", "7"): ("crm/7", False), ("crm", "8"): ("crm/8", True),
        ("idp", "a"): ("crm/8", True), ("crm", "9"): ("crm/8", True), ("hr", "2"): ("hr/2", False),
    }


def test_identities_keep_their_types(spark):
    """A slash in a name moves no border, ids stay numbers, a NULL source is a source."""
    rows = [("a/b", 1, "x"), ("a", 1, None), (None, 2, "x"), ("a", 10, "y"), ("a", 9, "y"), ("z", 3, "only one")]
    df = spark.createDataFrame(rows, "source string, record_id bigint, mail string")
    out = match_identities(df, {"a": F.col("mail"), "a:": F.when(F.col("record_id") == 3, ":y").otherwise(None)})
    assert out.schema["canonical_record_id"].dataType.typeName() == "long"
    assert bag(out) == {
        ("a/b", 1, None, 2, False): 1, (None, 2, None, 2, False): 1, ("a", 1, "a", 1, False): 1,
        ("a", 9, "a", 9, True): 1, ("a", 10, "a", 9, True): 1, ("z", 3, "z", 3, False): 1,
    }
    assert match_identities(df.limit(0), {"a": F.col("mail")}).count() == 0
