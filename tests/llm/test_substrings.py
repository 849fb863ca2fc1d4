"""Word sequences that earlier documents hold, against a version over all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from terrace.llm import substrings
from terrace.llm.queries import QUERIES

from .plain import WORD, awkward


def plain(rows, least):
    """(key, words, removed, sha) of each row, over every window."""
    earliest = {}
    for key, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - least + 1):
            if key is not None:
                at = tuple(w[i : i + least])
                earliest[at] = min(earliest.get(at, key), key)
    out = []
    for key, text in rows:
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - least + 1):
            if key is not None and earliest[tuple(w[i : i + least])] < key:
                gone[i : i + least] = [True] * least
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((key, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, least=substrings.LEAST):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substrings.remove_repeats(docs, least=least).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in found.collect()), key=str)


def random_rows(seed, n=60, vocabulary=6):
    draw = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for key in range(n):
        words = [f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(0, 60))]
        for _ in range(draw.randrange(3)):
            at, size = draw.randrange(len(passage) - 5), draw.randrange(5, 30)
            words[draw.randrange(len(words) + 1) :][:0] = passage[at : at + size]
            words += passage[at : at + size]
        rows.append((key // 2 if draw.random() < 0.2 else key, draw.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(None, rows[0][1]), (3, None), (4, ""), rows[5], rows[5]]


@pytest.mark.parametrize("least", [6, 13])
def test_all_windows(spark, least):
    rows = random_rows(least)
    assert got(spark, rows, least) == plain(rows, least)


def test_few_words_everywhere(spark):
    """Anchors of equal words and a passage within one text."""
    rows = [(1, "a " * 40), (2, "a " * 20 + "b"), (3, "b " + "a b " * 20), (4, "a b " * 10 + "c"), (5, "a " * 13), (6, "a " * 12)]
    assert got(spark, rows) == plain(rows, 13)


def test_many_copies_of_one_passage(spark):
    passage = " ".join(f"x{k}" for k in range(30))
    rows = [(k, f"{passage} own{k}" if k % 3 else f"own{k} {passage}") for k in range(900)] + [(k, passage) for k in range(900, 1200)]
    assert got(spark, rows) == plain(rows, 13)


def test_blocks_of_a_long_text(spark, monkeypatch):
    rows = random_rows(7, 20)
    hashes = np.random.default_rng(1).integers(0, 1 << 62, 500, dtype=np.uint64)
    counts = np.array([120, 0, 5, 375])
    whole = substrings.runs(hashes, counts, 13)
    monkeypatch.setattr(substrings, "BLOCK", 50)
    parts = substrings.runs(hashes, counts, 13)
    spread = lambda x: [(t, f + k, s) for s, t, f, n in zip(*(v.tolist() for v in x)) for k in range(n)]
    assert spread(whole) == spread(parts) and len(spread(whole)) == sum(max(0, c - 12) for c in counts)
    assert got(spark, rows) == plain(rows, 13)


def test_awkward(spark):
    docs = awkward(spark).unionByName(awkward(spark).selectExpr("doc_id + 100 AS doc_id", "text", "lang", "source", "n_chars", "score"))
    found = substrings.remove_repeats(docs.withColumn("sha", docs.doc_id).withColumn("seed", docs.text).withColumn("tid", docs.lang))
    rows = sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert rows == plain([(r.doc_id, r.text) for r in docs.collect()], 13)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_repeats_are_maximal(spark):
    first = [f"a{k}" for k in range(50)]
    rows = [(1, " ".join(first)), (2, " ".join(["x", *first[:20], "y", *first[20:50]])), (3, " ".join(first[:12]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substrings.remove_repeats(docs).collect()}
    assert [tuple(s) for s in found[2].repeats] == [(1, 21), (22, 52)] and bytes(found[2].kept) == b"x y"
    assert found[1].repeats is None and found[3].repeats is None


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_substrings"](spark, sf)
    assert sorted((tuple(r)[:4] for r in found.collect()), key=str) == plain(rows, 13)
    assert defaultdict(int, found.agg({"n_removed": "sum"}).first().asDict())["sum(n_removed)"] > 0
