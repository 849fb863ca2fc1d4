"""Layout, federation, workspaces, sharing, identity plans."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators import hierarchy, identity, layout, sharing
from terrace.operators.gold import all_sets, conform_star, gold_aggregate
from terrace.session import scratch_path, shared_dir
from terrace.sources import foreign
from tests.helpers import bag, executed_plan, ts

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture(scope="module")
def line(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet")


def test_partition_overwrite_touches_only_its_partitions(spark):
    path = scratch_path(spark, "parts")
    layout.write_partitioned(spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string"), path, ["p"])
    for _ in range(2):
        layout.write_partitioned(spark.createDataFrame([(3, "b"), (4, "b")], "id int, p string"), path, ["p"], ["id"], 1)
    out = spark.read.parquet(path)
    assert bag(out, "id", "p") == {(1, "a"): 1, (3, "b"): 1, (4, "b"): 1}
    assert out.filter("p = 'b'").select("_metadata.file_path").distinct().count() == 2
    assert "PartitionFilters: [isnotnull(p" in executed_plan(out.filter("p = 'b'"))


def test_compaction_keeps_the_rows(spark, line):
    small, packed = scratch_path(spark, "small"), scratch_path(spark, "packed")
    line.repartition(16).write.parquet(small)
    assert layout.compact_partitions(spark, small, packed, 100_000) < 16
    assert bag(spark.read.parquet(packed)) == bag(line)
    by_flag, packed = scratch_path(spark, "small"), scratch_path(spark, "packed")
    line.repartition(8).write.partitionBy("l_returnflag").parquet(by_flag)
    before = len(spark.read.parquet(by_flag).inputFiles())
    assert layout.compact_partitions(spark, by_flag, packed, by=["l_returnflag"]) < before
    copy = spark.read.parquet(packed)
    assert bag(copy, *line.columns) == bag(line)
    assert all("l_returnflag=" in file for file in copy.inputFiles())


@pytest.mark.parametrize("method", ["range", "zorder"])
def test_clustering_keeps_rows_and_skips_files(spark, line, method):
    cols = ["l_partkey", "l_suppkey"]
    path = scratch_path(spark, method)
    layout.cluster_layout(line, cols, method, files=16, bits=4).write.parquet(path)
    stored = spark.read.parquet(path)
    assert bag(stored) == bag(line)
    stats = layout.file_stats(stored, cols)
    skipped = layout.prunable_files(stats, "l_partkey", 10, 20)
    assert skipped.count() >= 8
    if method == "zorder":
        assert layout.prunable_files(stats, "l_suppkey", 1, 1).count() >= 4
    hit = {r[0] for r in stored.filter("l_partkey between 10 and 20").select("_metadata.file_path").distinct().collect()}
    assert not hit & {r[0] for r in skipped.collect()}


def test_statistics_with_nulls(spark):
    path = scratch_path(spark, "stats")
    spark.createDataFrame([(1, None), (5, None)], "a int, b double").coalesce(1).write.parquet(path)
    stats = layout.file_stats(spark.read.parquet(path), ["a", "b"])
    assert bag(stats, "column", "n_rows", "n_null", "low", "high") == {("a", 2, 0, 1.0, 5.0): 1, ("b", 2, 2, None, None): 1}
    assert layout.prunable_files(stats, "b", 0, 9).count() == 1
    assert layout.prunable_files(stats, "a", 5, 9).count() == 0


def test_buckets_join_without_a_shuffle(spark, sf, line):
    tag = scratch_path(spark, "b").rsplit("-", 1)[1]
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    layout.bucket_table(line, f"l_{tag}", ["l_orderkey"], 4, scratch_path(spark, "bl"))
    layout.bucket_table(orders, f"o_{tag}", ["o_orderkey"], 4, scratch_path(spark, "bo"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spark.table(f"l_{tag}").join(spark.table(f"o_{tag}"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "o_custkey")
        plan = executed_plan(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_salted_buckets(spark):
    """A hot key lies in several buckets; joins give the rows of the plain join, also of NULL keys and keys of one side."""
    rows = [(1, k) for k in range(900)] + [(None, k) for k in range(300)] + [(k, 0) for k in range(2, 40)]
    large = spark.createDataFrame(rows, "k int, v int").repartition(3)
    other = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n"), (99, "z")], "k int, w string")
    tag = scratch_path(spark, "b").rsplit("-", 1)[1]
    names = (f"large_{tag}", f"other_{tag}")
    layout.bucket_pair(large, other, names, ["k"], 8, tuple(scratch_path(spark, n) for n in names), hot_rows=100)
    left, right = (spark.table(n) for n in names)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            out = left.join(right, ["k", layout.SALT], how)
            assert bag(out, "k", "v", "w") == bag(large.join(other, "k", how), "k", "v", "w")
            plan = executed_plan(out)
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert bag(left, "k", "v") == bag(large, "k", "v") and bag(right.filter("__salt = 0"), "k", "w") == bag(other, "k", "w")
    sizes = {r["k"]: r["most"] for r in left.groupBy("k", layout.SALT).count().groupBy("k").agg(F.max("count").alias("most")).collect()}
    assert sizes[1] < 200 and sizes[None] < 150 and sizes[2] == 1
    buckets = left.filter("k = 1").select(F.pmod(F.hash("k", layout.SALT), F.lit(8))).distinct().count()
    assert buckets > 2


def test_star_and_groupings(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    dim = spark.createDataFrame([(1, "one", 5)], "dk int, name string, size int")
    star = conform_star(fact, {"d": (dim, "k", "dk")})
    assert bag(star) == {(1, 10, "one", 5): 1, (2, 20, "UNKNOWN", None): 1, (None, 30, "UNKNOWN", None): 1}
    n = {"n": F.count(F.lit(1))}
    cube = gold_aggregate(star, ["name", "k"], n, "cube")
    assert bag(cube) == bag(gold_aggregate(star, ["name", "k"], n, "sets", all_sets(["name", "k"])), *cube.columns)
    with pytest.raises(ValueError):
        gold_aggregate(star, ["k"], n, "pivot")


def test_federated_join_pushes_keys(spark, sf):
    remote = spark.read.parquet(f"{sf}/customer.parquet").withColumnRenamed("c_nationkey", "k")
    local = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "k int, tag string")
    shrunk = foreign.join_federated(local, remote, "k")
    assert "In(c_nationkey, [1,2])" in executed_plan(shrunk)
    whole = foreign.join_federated(local, remote, "k", ranges=1)
    assert "GreaterThanOrEqual(c_nationkey,1)" in executed_plan(whole) and "LessThanOrEqual(c_nationkey,2)" in executed_plan(whole)
    assert bag(shrunk) == bag(whole) == bag(local.join(remote, "k"))
    assert foreign.join_federated(local.filter("k is null"), remote, "k").count() == 0
    assert foreign.join_federated(local, remote, "k", how="left").count() == shrunk.count() + 1
    with pytest.raises(ValueError):
        foreign.join_federated(local, remote, "k", how="right")


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "double"])
def test_federated_join_by_ranges_of_any_type(spark, kind):
    """Many keys in two far clusters: few ranges apart from each other cover them, and the join is the plain one."""
    key = {"bigint": F.col("id"), "double": F.col("id") / 4, "string": F.format_string("k%07d", "id"), "date": F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))}[kind]
    every = spark.range(0, 30_000).select(key.alias("k"), "id")
    ends = every.filter("id < 3000 or id >= 27000").filter("id % 3 = 0").select("k").unionAll(spark.range(2).select(F.lit(None).cast(every.schema["k"].dataType).alias("k")))
    bounds = sorted((r["low"], r["high"]) for r in foreign.key_ranges(ends, "k", 16).collect())
    keys = sorted(r["k"] for r in ends.dropna().collect())
    assert 8 <= len(bounds) <= 16 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert all(any(low <= k <= high for low, high in bounds) for k in keys)
    # the ranges are apart, so at most one of them spans the gap
    assert sum(low <= keys[999] and high >= keys[1000] for low, high in bounds) <= 1
    out = foreign.join_federated(ends, every, "k", ranges=16)
    assert out.count() == 2000 and bag(out) == bag(ends.join(every, "k"))


def test_reconcile_sources(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, v string")
    assert foreign.reconcile_sources(a, a.orderBy(F.desc("k")), ["k"]).count() == 0
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (4, "w")], "k int, v string")
    assert bag(foreign.reconcile_sources(a, b, ["k"]), "change", "k") == {("update", 2): 1, ("delete", 3): 1, ("insert", 4): 1}


def test_increments(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    assert foreign.pull_increment(df, "c").count() == 3
    assert bag(foreign.pull_increment(df, "c", foreign.high_water_mark(df.filter("c < 3"), "c"))) == {(2,): 1, (3,): 1}


def test_increments_lose_no_tie_and_no_row_without_cursor(spark):
    rows = [("old", 1), ("held", 2), ("late tie", 2), ("new", 3), ("blank held", None), ("blank new", None)]
    remote = spark.createDataFrame(rows, "k string, c int")
    marks = scratch_path(spark, "marks")
    assert foreign.stored_mark(spark, marks) is None
    pulled = remote.filter("k in ('old', 'held', 'blank held')")
    foreign.store_mark(pulled, "c", marks)
    foreign.store_mark(pulled.filter("k = 'old'"), "c", marks)
    foreign.store_mark(pulled.limit(0), "c", marks)
    fresh = foreign.pull_increment(remote, "c", foreign.stored_mark(spark, marks), pulled, ["k"])
    assert {r["k"] for r in fresh.collect()} == {"late tie", "new", "blank new"}


def test_parallel_read_options(monkeypatch, spark):
    """No database runs here, so only what is handed to the reader is checked."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    assert foreign.read_foreign_parallel(Session(), "jdbc:x", "t", "id", 1, 100, 8, {"driver": "d"}) == "frame"
    assert seen == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "driver": "d", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        foreign.read_foreign_parallel(Session(), "jdbc:x", "t", "id", 1, 100, 0)


def test_routing_keeps_unmapped_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    mapping = spark.createDataFrame([("a", "w1"), ("a", "w1")], "k string, workspace string")
    path = scratch_path(spark, "route")
    hierarchy.route_by_workspace(df, "k", mapping, path)
    assert bag(spark.read.parquet(path), "id", "workspace") == {(1, "w1"): 1, (2, "_unmapped"): 1, (3, "_unmapped"): 1}


def test_bindings(spark):
    spaces = spark.createDataFrame([("w1",), ("w2",)], "workspace string")
    catalogs = spark.createDataFrame([("c1", False), ("open", True)], "catalog string, is_open boolean")
    bound = spark.createDataFrame([("w1", "c1"), ("w1", "c1"), ("w9", "c1"), ("w1", "gone")], "workspace string, catalog string")
    visible = hierarchy.resolve_bindings(spaces, catalogs, bound)
    assert bag(visible) == {("w1", "c1"): 1, ("w1", "open"): 1, ("w2", "open"): 1}
    log = spark.createDataFrame([("w1", "c1"), ("w2", "c1"), ("w2", "c1"), ("w2", "open")], "workspace string, catalog string")
    assert visible.count() > 0
    assert bag(hierarchy.binding_violations(spaces, catalogs, bound, log)) == {("w2", "c1", 2): 1}
    closed = catalogs.filter("not is_open")
    assert bag(hierarchy.resolve_bindings(spaces, closed, bound)) == {("w1", "c1"): 1}


def test_catalog_report(spark):
    objects = spark.createDataFrame([(1, "ann"), (2, None), (3, "bob")], "object_id int, owner string")
    day = [ts(f"2024-0{m}-01T00:00:00") for m in (1, 6, 7)]
    log = spark.createDataFrame([(1, "x", day[1]), (1, "x", day[0]), (1, "y", day[1]), (2, "x", day[0]), (3, "x", day[2])], "object_id int, reader string, at timestamp_ntz")
    as_of = F.lit("2024-06-15").cast("timestamp_ntz")
    out = hierarchy.catalog_report(objects, log, as_of, 30)
    assert bag(out, "object_id", "n_readers", "n_reads", "is_stale", "is_ownerless") == {
        (1, 2, 3, False, False): 1, (2, 1, 1, True, True): 1, (3, 0, 0, True, False): 1
    }


def test_shares(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, k string")
    rights = spark.createDataFrame([("r1", "a"), ("r1", "a"), ("r2", "z"), ("r3", "b")], "recipient string, k string")
    assert bag(sharing.share_by_recipient(df, rights, ["k"]), "recipient", "id") == {("r1", 1): 1, ("r1", 3): 1, ("r3", 2): 1}
    assert bag(sharing.build_share(df, ["id"], F.col("k") == "a")) == {(1,): 1, (3,): 1}
    use = sharing.share_usage(rights.select("k"), df.select("k"), ["k"])
    assert bag(use) == {("unused_grant", "z"): 1}


people = st.dictionaries(st.integers(1, 6), st.tuples(st.sampled_from(["x", "y", None]), st.booleans()), max_size=6)


@FEW
@given(directory=people, current=people)
def test_plan_leaves_nothing_to_do(spark, directory, current):
    d, c = (spark.createDataFrame([(k, v, a) for k, (v, a) in s.items()], "k int, v string, active boolean") for s in (directory, current))
    plan = identity.provision_plan(d, c, "k", ["v"])
    after = identity.apply_plan(c, plan, "k", ["v"])
    assert identity.provision_plan(d, after, "k", ["v"]).count() == 0
    live = {k: v for k, (v, a) in directory.items() if a}
    assert {r["k"]: r["v"] for r in after.filter("active").collect()} == live


def test_provision_actions(spark):
    schema = "k int, v string, active boolean"
    directory = spark.createDataFrame([(1, "a", True), (2, "B", True), (3, "c", True), (4, "d", False), (6, "f", False)], schema)
    current = spark.createDataFrame([(2, "b", True), (3, "c", False), (4, "d", True), (5, "e", True)], schema)
    assert bag(identity.provision_plan(directory, current, "k", ["v"])) == {
        (1, "create", "a"): 1, (2, "update", "B"): 1, (3, "reactivate", "c"): 1, (4, "deactivate", "d"): 1, (5, "deactivate", "e"): 1
    }


def test_memberships_orphans_drift(spark):
    pair = "member string, group string"
    want, have = spark.createDataFrame([("a", "g"), ("b", "g")], pair), spark.createDataFrame([("b", "g"), ("c", "g"), ("c", "g")], pair)
    assert bag(identity.membership_plan(want, have)) == {("add", "a", "g"): 1, ("remove", "c", "g"): 1}
    grants = spark.createDataFrame([("a", "t"), ("b", "t"), ("z", "t"), ("n", "t")], "principal string, object_id string")
    users = spark.createDataFrame([("a", True), ("b", False), ("n", None)], "principal string, active boolean")
    assert bag(identity.orphaned_access(grants, users), "principal", "reason") == {("b", "inactive"): 1, ("z", "unknown"): 1, ("n", "inactive"): 1}
    conf = "env string, resource string, key string, value string"
    desired = spark.createDataFrame([("p", "r", "a", "1"), ("p", "r", "b", "2"), ("p", "r", "c", None)], conf)
    actual = spark.createDataFrame([("p", "r", "b", "3"), ("p", "r", "c", None), ("q", "r", "a", "1")], conf)
    assert bag(identity.config_drift(desired, actual), "env", "key", "drift", "desired", "actual") == {
        ("p", "a", "missing", "1", None): 1, ("p", "b", "changed", "2", "3"): 1, ("q", "a", "extra", None, "1"): 1
    }


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or scratch_path(spark, "x").startswith(named.rstrip("/"))
    assert shared_dir(spark) == shared_dir(spark)


def test_violations_write_no_pairs(spark):
    """Open catalogs are a flag: unknown workspaces and accesses without a name are violations, and nothing is multiplied."""
    spaces = spark.createDataFrame([(f"w{k}",) for k in range(300)], "workspace string")
    catalogs = spark.createDataFrame([(f"c{k}", k % 2 == 0) for k in range(300)], "catalog string, is_open boolean")
    bound = spark.createDataFrame([("w1", "c1"), ("w1", "c1"), ("x", "c3")], "workspace string, catalog string")
    log = spark.createDataFrame([("w1", "c1"), ("w2", "c1"), ("w2", "c2"), ("x", "c2"), ("x", "c3"), ("w3", None), (None, "c2"), ("w4", "z")], "workspace string, catalog string")
    found = hierarchy.binding_violations(spaces, catalogs, bound, log)
    assert bag(found, "workspace", "catalog") == {("w2", "c1"): 1, ("x", "c2"): 1, ("x", "c3"): 1, ("w3", None): 1, (None, "c2"): 1, ("w4", "z"): 1}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "Generate" not in plan


@pytest.mark.parametrize("method", ["zorder", "hilbert"])
def test_times_and_texts_are_clustered(spark, line, tmp_path, method):
    path = str(tmp_path / method)
    layout.cluster_layout(line, ["l_shipdate", "l_returnflag"], method, files=16).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.columns == line.columns and bag(stored, "l_orderkey", "l_linenumber") == bag(line, "l_orderkey", "l_linenumber")
    stats = layout.file_stats(stored, ["l_shipdate", "l_returnflag"])
    gone = {r["file"] for r in layout.prunable_files(stats, "l_shipdate", "1996-01-01", "1996-03-31", stored.schema["l_shipdate"].dataType).collect()}
    assert gone
    inside = stored.filter("l_shipdate BETWEEN TIMESTAMP_NTZ '1996-01-01' AND TIMESTAMP_NTZ '1996-03-31'").select("_metadata.file_path").distinct()
    assert not gone & {r[0] for r in inside.collect()}
    texts = {r["file"] for r in layout.prunable_files(stats, "l_returnflag", "R", "R", stored.schema["l_returnflag"].dataType).collect()}
    assert not texts & {r[0] for r in stored.filter("l_returnflag = 'R'").select("_metadata.file_path").distinct().collect()}


def test_hilbert_neighbours_touch(spark):
    """On a full grid every step of the curve goes to a neighbour, and every place is met once."""
    grid = spark.range(256).select((F.col("id") % 16).alias("a"), F.floor(F.col("id") / 16).alias("b"))
    walk = [(r["a"], r["b"], r["h"]) for r in layout._hilbert(grid, ["a", "b"], 4, "h").orderBy("h").collect()]
    assert [h for *_, h in walk] == list(range(256))
    assert all(abs(p[0] - q[0]) + abs(p[1] - q[1]) == 1 for p, q in zip(walk, walk[1:]))


def test_order_keys_never_swap(spark):
    rows = [(None, None), ("", "1960-01-01"), ("a", "1970-01-01"), ("ab", "1999-12-31"), ("abcdefg", "2000-01-01"), ("abcdefh", "2024-02-29"), ("z", "2100-01-01"), ("é", "2200-01-01")]
    df = spark.createDataFrame(rows, "s string, d string").withColumn("day", F.col("d").cast("date")).withColumn("t", F.col("d").cast("timestamp_ntz"))
    keys = df.select(*[layout.order_key(F.col(c), df.schema[c].dataType).alias(c) for c in ("s", "day", "t")]).collect()
    assert tuple(keys[0]) == (None, None, None)
    for column in range(3):
        assert [k[column] for k in keys[1:]] == sorted(k[column] for k in keys[1:])


def test_bit_sets_lose_no_file(spark, line, tmp_path):
    path = str(tmp_path / "filtered")
    line.repartition(8, F.xxhash64("l_orderkey", "l_linenumber")).write.parquet(path)
    stored = spark.read.parquet(path)
    files = stored.select(F.col("_metadata.file_path").alias("file")).distinct()
    filters = layout.file_filters(stored, "l_partkey", bits=1 << 14)
    assert filters.count() <= 8 * (1 << 14) // 64
    skipped = 0
    for value in (1, 17, 155, 10**9):
        gone = {r["file"] for r in layout.files_without(filters, files, F.lit(value).cast("bigint"), bits=1 << 14).collect()}
        assert not gone & {r[0] for r in stored.filter(F.col("l_partkey") == value).select("_metadata.file_path").distinct().collect()}
        skipped += len(gone)
    assert skipped >= 8


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(layout, "FILE_ROWS", 100)
    large, other = spark.range(3000).select((F.col("id") % 3).alias("k"), "id"), spark.range(3).select(F.col("id").alias("k"))
    tag = scratch_path(spark, "b").rsplit("-", 1)[1]
    names = (f"large_{tag}", f"other_{tag}")
    layout.bucket_pair(large, other, names, ["k"], 8, tuple(scratch_path(spark, n) for n in names), hot_rows=100)
    for name in names:
        found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert found["Num Buckets"] == "30"
    joined = spark.table(names[0]).join(spark.table(names[1]), ["k", layout.SALT])
    assert bag(joined, "k", "id") == bag(large, "k", "id")
    assert layout.parts_for(0, 8) == layout.parts_for(800, 8) == 8 and layout.parts_for(801, 8) == 9


def test_files_grow_with_the_rows(spark, line, tmp_path, monkeypatch):
    monkeypatch.setattr(layout, "FILE_ROWS", 200)
    path = str(tmp_path / "many")
    layout.cluster_layout(line, ["l_orderkey"], "range", files=8).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == line.count() and len(sizes) > 20 and max(sizes) < 600


def test_ranks_are_one_small_expression(spark, line):
    """The value is taken once, and no chain of projections is left that would make a method too long for the JVM."""
    cuts = [1.0, 3.0, 3.0, 5.0, 8.0, 9.0, 11.0]
    df = spark.createDataFrame([(v,) for v in (None, 0.0, 1.0, 2.0, 3.0, 8.5, 11.0, 99.0, float("nan"))], "v double")
    assert [r[0] for r in df.select(layout._rank(F.col("v"), cuts, 3)).collect()] == [0, 0, 1, 1, 3, 5, 7, 7, 7]
    plan = layout.cluster_layout(line, ["l_shipdate", "l_returnflag"], "hilbert", files=4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") < 10 and plan.count("conv(") == 1


def test_share_usage_in_one_aggregate(spark):
    """A task holds each pair once: nothing is joined; NULL equals nothing, so it is found on both sides."""
    kind = "a int, b string"
    grants = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (None, "n"), (3, None)], kind)
    reads = spark.createDataFrame([(1, "x"), (4, "y"), (4, "y"), (None, "n")], kind)
    use = sharing.share_usage(grants, reads, ["a", "b"])
    assert bag(use) == {
        ("unused_grant", 2, "x"): 1, ("unused_grant", None, "n"): 1, ("unused_grant", 3, None): 1,
        ("ungranted_read", 4, "y"): 1, ("ungranted_read", None, "n"): 1,
    }
    assert "Join" not in executed_plan(use)
