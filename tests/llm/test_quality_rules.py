from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import connect, mismatch
from tests.llm.plain import WORD, awkward
from terrace.llm import quality_rules
from terrace.llm.queries import ORACLES, QUERIES


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_query(spark, sf):
    assert mismatch(QUERIES["op2_quality_rules"](spark, sf), connect(sf), ORACLES["op2_quality_rules"]) is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab|\n\t !#é", max_size=60), max_size=6), st.sampled_from([0, 1, quality_rules.LOOKED_UP]))
def test_counts(spark, texts, looked_up):
    before, quality_rules.LOOKED_UP = quality_rules.LOOKED_UP, looked_up
    try:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in quality_rules.judge(docs).collect()}
    finally:
        quality_rules.LOOKED_UP = before
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_awkward(spark):
    docs = awkward(spark).withColumnRenamed("score", "kept")
    rows = quality_rules.judge(docs).collect()
    texts = [r["text"] for r in docs.collect()]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == sorted(map(plain, texts))
    assert all(isinstance(r["kept"], bool) for r in rows)
    assert quality_rules.judge(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text, rule",
    [
        ("good words the of and in this text " * 1 + " ".join(f"word{i} the" for i in range(80)), None),
        (" ".join(f"w{i}!!" for i in range(80)), "shouting"),
        (" ".join(f"w{i} |" for i in range(80)), "symbols"),
        (" ".join(f"WORD{i}" for i in range(80)), "capitals"),
    ],
)
def test_rules(spark, text, rule):
    row = quality_rules.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["broken_rule"] == rule and row["kept"] == (rule is None and not row["base_failed"])


def test_no_user_function(spark, sf):
    plan = QUERIES["op2_quality_rules"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
