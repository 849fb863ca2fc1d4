"""Encryption, pseudonyms, patterns, networks."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terrace.functions.patterns import SENSITIVE
from terrace.operators import protection as p
from tests.helpers import bag


@pytest.fixture(scope="module")
def ring(spark):
    rows = [("a", 1, b"0" * 16), ("a", 2, b"1" * 16), ("a", 3, b"2" * 32), ("b", 1, b"3" * 16), ("b", 2, b"4" * 16)]
    return spark.createDataFrame(rows, "tenant string, key_version int, key binary")


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame([(1, "a", "x", 1.5), (2, "a", None, None), (3, "b", "", -2.0)], "id int, tenant string, s string, d double")


def test_round_trip_and_rotation(spark, data, ring):
    sealed = p.encrypt_columns(data, ["s", "d"], ring, "tenant", 1)
    assert dict(sealed.dtypes)["s"] == dict(sealed.dtypes)["d"] == "binary"
    types = {"s": "string", "d": "double"}
    assert bag(p.decrypt_columns(sealed, types, ring, "tenant")) == bag(data)
    twice = p.rotate_keys(p.rotate_keys(sealed.filter("tenant = 'a'"), ["s", "d"], ring, "tenant", 2), ["s", "d"], ring, "tenant", 3)
    assert {r["key_version"] for r in twice.collect()} == {3}
    assert bag(p.decrypt_columns(twice, types, ring, "tenant")) == bag(data.filter("tenant = 'a'"))


def test_newer_rows_keep_their_bytes(spark, data, ring):
    sealed = p.encrypt_columns(data, ["s"], ring, "tenant", 2)
    fixed = sealed.sparkSession.createDataFrame(sealed.collect(), sealed.schema)
    assert bag(p.rotate_keys(fixed, ["s"], ring, "tenant", 2), "id", "s") == bag(fixed, "id", "s")


def test_missing_and_wrong_keys_stop_the_job(spark, data, ring):
    with pytest.raises(PySparkException, match="no key for version 9"):
        p.encrypt_columns(data, ["s"], ring, "tenant", 9).collect()
    sealed = p.encrypt_columns(data, ["s"], ring, "tenant", 1)
    wrong = ring.withColumn("key", F.lit(b"9" * 16))
    with pytest.raises(PySparkException):
        p.decrypt_columns(sealed, {"s": "string"}, wrong, "tenant").collect()


def test_equal_values_have_different_ciphertext(spark, ring):
    df = spark.createDataFrame([(i, "a", "same") for i in range(20)], "id int, tenant string, s string")
    out = p.encrypt_columns(df, ["s"], ring, "tenant", 1)
    assert len({bytes(r["s"]) for r in out.collect()}) == 20


def test_keys_do_not_show_in_plans(data, ring):
    plan = p.encrypt_columns(data, ["s"], ring, "tenant", 1)._jdf.queryExecution().toString()
    assert "0000000000000000" not in plan


def test_pseudonyms_join(spark, data):
    once, again = p.pseudonymise(data, ["s"], "k"), p.pseudonymise(data, ["s"], "k")
    assert once.join(again, "s").count() == 2  # NULL stays NULL and joins nothing
    assert p.pseudonymise(data, ["s"], "other").join(once, "s").count() == 0


TEXT = 'mail a.b@c.org, ip 10.0.0.1, call +1 (555) 555-0100, card 1234 5678 1234 5678, token = "ab12ef"'
SECRET = "api_key=Zq81mmplx04Trw"


def test_redaction_and_scan(spark):
    df = spark.createDataFrame([(1, f"{TEXT}, {SECRET}"), (2, "nothing"), (3, None)], "id int, text string")
    out = {r["id"]: r["text"] for r in p.redact_text(df, "text").collect()}
    assert out == {1: "mail <EMAIL>, ip <IP>, call <PHONE>, card <CARD>, <TOKEN>, <SECRET>", 2: "nothing", 3: None}
    scan = p.scan_sensitive(df, ["text"])
    assert bag(scan, "tag", "hits", "n_rows") == {(t, 1, 3): 1 for t in SENSITIVE}
    tags = p.tags_from_scan(scan.withColumn("object", F.lit("docs")), "object", 0.5)
    assert tags.count() == 0


def test_common_forms(spark):
    cases = [
        ("call +49 30 1234567 now", "call <PHONE> now"), ("call +1 555-123-4567 now", "call <PHONE> now"),
        ("call +1 (555) 123-4567 12 times", "call <PHONE> 12 times"), ("+44 20 7946 0958.", "<PHONE>."),
        ("secret_key=abcdef0123456789", "<SECRET>"), ('API-KEY: "AKIA1234567890"', '<SECRET>"'), ("access: administrator", "access: administrator"),
        ("999.999.999.999", "999.999.999.999"), ("at 255.0.10.1 up", "at <IP> up"), ("1 + 2 = 3", "1 + 2 = 3"), (None, None),
    ]
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "id int, t string")
    assert {r["id"]: r["t"] for r in p.redact_text(df, "t").collect()} == {i: want for i, (_, want) in enumerate(cases)}


def test_addresses(spark):
    df = spark.createDataFrame([("10.0.0.1",), ("256.0.0.1",), ("1.2.3",), ("a.b.c.d",), (None,)], "a string")
    assert [r[0] for r in df.select(p.ipv4_number("a")).collect()] == [167772161, None, None, None, None]


def test_networks(spark):
    log = spark.createDataFrame([(1, 99), (2, 100), (3, 200), (4, 201), (5, 70_000), (6, 140_000), (7, None)], "id int, addr bigint")
    allow = spark.createDataFrame([(100, 200), (150, 180), (65_000, 135_000)], "low bigint, high bigint")
    assert bag(p.network_violations(log, "addr", allow), "id") == {(1,): 1, (4,): 1, (6,): 1, (7,): 1}
    assert p.network_violations(log, "addr", allow.limit(0)).count() == 7
