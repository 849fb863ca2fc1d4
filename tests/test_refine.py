"""Ingest, schemas, rules, duplicates."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.operators.refine import dedupe_latest, expect, reconcile_schema, rule_counts
from terrace.session import scratch_path, write_through
from terrace.sources.files import ingest_files, split_corrupt
from tests.helpers import bag, executed_plan

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def write_text(spark, lines):
    path = scratch_path(spark, "in")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_json_edges(spark):
    lines = ['{"id": 1, "name": "a"}', "{oops", '{"id": "x", "name": "b"}', '{"id": 2, "name": "c", "more": 1}', '{"id": 3}']
    loaded = write_through(ingest_files(spark, write_text(spark, lines), "json", SCHEMA), "b")
    good, bad = split_corrupt(loaded)
    assert bag(good, "id", "name") == {(1, "a"): 1, (2, "c"): 1, (3, None): 1}
    assert {r["_corrupt_record"] for r in bad.collect()} == {lines[1], lines[2]}
    assert good.filter("_src_file is null or _src_mtime is null or _ingested_at is null").count() == 0


def test_empty_files(spark):
    assert ingest_files(spark, write_text(spark, []), "json", SCHEMA).count() == 0
    header = ingest_files(spark, write_text(spark, ["id,name"]), "csv", SCHEMA, {"header": "true"})
    assert header.count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc", "xml"])
def test_formats_round_trip(spark, fmt):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "x y")], SCHEMA)
    path = scratch_path(spark, fmt)
    writer = df.write.format(fmt)
    options = {"rowTag": "row"} if fmt == "xml" else {}
    writer.options(**options).save(path)
    assert bag(ingest_files(spark, path, fmt, SCHEMA, options), "id", "name") == bag(df)


def test_declared_schema_is_required(spark):
    with pytest.raises(ValueError):
        ingest_files(spark, "/nowhere", "json")
    with pytest.raises(ValueError):
        ingest_files(spark, "/nowhere", "avro", SCHEMA)


def test_reconcile(spark):
    df = spark.createDataFrame([("12", "a", 5), ("x", None, 6)], "id string, name string, extra int")
    out = reconcile_schema(df, T.StructType.fromDDL("id bigint, name string, born date"))
    assert out.dtypes == [("id", "bigint"), ("name", "string"), ("born", "date"), ("_extra", "string")]
    assert bag(out) == {(12, "a", None, '{"extra":5}'): 1, (None, None, None, '{"extra":6}'): 1}


def test_rules(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rules = {"positive": F.col("v") > 0, "odd": F.col("id") % 2 == 1}
    warned = {r["id"]: r["_failed_rules"] for r in expect(df, rules, "warn").collect()}
    assert warned == {1: [], 2: ["positive", "odd"], 3: ["positive"]}
    counts = Observation()
    assert bag(expect(df, rules, "drop", counts), "id") == {(1,): 1}
    assert counts.get == {"n_rows": 3, "failed_positive": 2, "failed_odd": 1}
    good, bad = expect(df, rules, "quarantine")
    assert (bag(good, "id"), bag(bad, "id")) == ({(1,): 1}, {(2,): 1, (3,): 1})
    with pytest.raises(PySparkException, match="quality rule failed"):
        expect(df, rules, "fail").collect()
    assert expect(df.filter("id = 1"), rules, "fail").count() == 1
    assert bag(rule_counts(df, rules)) == {("positive", 1, 2): 1, ("odd", 2, 1): 1}
    assert bag(rule_counts(df.limit(0), rules)) == {("positive", 0, 0): 1, ("odd", 0, 0): 1}


def test_rules_reach_the_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = executed_plan(expect(df, {"q": F.col("l_quantity") > 10}, "drop").select("l_orderkey"))
    assert "GreaterThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_latest_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, s int, v string")
    out = dedupe_latest(df, ["k"], [F.col("s").desc()])
    assert bag(out) == {(1, 2, "b"): 1, (2, 1, "c"): 1}
    plan = executed_plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan
