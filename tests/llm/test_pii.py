import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.plain import awkward, base_spans
from terrace.llm import pii
from terrace.llm.queries import QUERIES
from terrace.sources.tables import table


def check(rows, texts):
    for r in rows:
        want = base_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["spans"].startswith(joined)


def test_query(spark, sf):
    rows = QUERIES["op5_personal_data"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    assert len(rows) == len(texts)
    check(rows, texts)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="a9@.-+ ()1_%é😀:", max_size=50), min_size=1, max_size=8))
def test_base_spans(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", pii.base_spans("text").alias("s")).collect()
    assert {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["s"]] for r in got} == {i: base_spans(t) for i, t in enumerate(texts)}


def test_long_runs_and_many_matches(spark):
    texts = ["a" * 200_000, "a@" + "b.c" * 50_000, "1" * 100_000, "a@b.c_d@e.f " * 500, "4111 1111 1111 1111 " * 300, "+1 " * 20_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = docs.select("doc_id", pii.base_spans("text").alias("s")).collect()
    assert {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["s"]] for r in got} == {i: base_spans(t) for i, t in enumerate(texts)}


def test_awkward(spark):
    docs = awkward(spark)
    rows = pii.find_personal_data(docs).collect()
    want = sorted((repr(r["doc_id"]), base_spans(r["text"])) for r in docs.collect())
    assert sorted((repr(r["doc_id"]), [(s["kind"], s["start"], s["end"]) for s in r["base"]]) for r in rows) == want
    assert pii.find_personal_data(docs.limit(0)).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    known = [(i, f"Please write to member id: ann{i}@example.org or ask for it.") for i in range(20)]
    unseen = [(100 + i, f"Please write to member id: AB-{i}77x or ask for it.") for i in range(3)]
    other = [(200 + i, f"It was built in year {1900 + i} by hand, see chapter {i}.") for i in range(30)]
    docs = spark.createDataFrame(known + unseen + other, "doc_id long, text string")
    rows = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["spans"]] for r in pii.find_personal_data(docs).collect()}
    assert [rows[100 + i] for i in range(3)] == [[(pii.FOUND, f"AB-{i}77x")] for i in range(3)]
    assert all(rows[200 + i] == [] for i in range(30)) and all(len(rows[i]) == 1 for i in range(20))


def test_seeds_without_digits_teach(spark):
    names = [a + b for a in ("ann", "bob", "eve", "kim", "lou", "sam") for b in ("ford", "hill", "lake", "moor", "wood")]
    known = [(i, f"Please write to member id: {n}@example.org or ask for it.") for i, n in enumerate(names)]
    unseen = [(100 + i, f"Please write to member id: AB-{i}77x or ask for it.") for i in range(5)]
    docs = spark.createDataFrame(known + unseen, "doc_id long, text string")
    rows = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["spans"]] for r in pii.find_personal_data(docs).collect()}
    assert [rows[100 + i] for i in range(5)] == [[(pii.FOUND, f"AB-{i}77x")] for i in range(5)]


def test_words_ahead_are_whole(spark):
    long = "x" * 5000
    docs = spark.createDataFrame([(1, f"a {long} 77 b  c 78 79")], "doc_id long, text string")
    words = docs.select(pii.instances("text").alias("w")).first()["w"]
    assert [w["ahead"] for w in words] == [f"a {long} ", "b  c ", ""]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="a9@.-+ ()1:", max_size=60), min_size=1, max_size=8))
def test_seeds_as_by_pairs(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.scan(docs).collect():
        for w in r["words"]:
            assert w["seed"] == any(s["start"] < w["end"] and w["start"] < s["end"] for s in r["base"])


def test_work_grows_with_the_matches(spark):
    """A text of 100,000 matches: every word is an instance, every second one a base span."""
    text = "".join(f"w{i} a{i}@b.cc " for i in range(50_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.scan(docs).first()
    assert len(row["words"]) == 100_000 and len(row["base"]) == 50_000
    assert [w["seed"] for w in row["words"]] == [False, True] * 50_000
    assert all(text[w["start"] : w["end"]] == w["value"] for w in row["words"])


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cc or +49 30 1234567 now")], "doc_id long, text string")
    spans = docs.withColumn("spans", pii.base_spans("text"))
    assert spans.select(pii.redact("text", "spans")).first()[0] == "mail <EMAIL> or <PHONE> now"


def test_no_python(spark, sf):
    plan = pii.scan(table(spark, sf, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
