import hashlib
import random

import numpy as np
import pytest

from tests.llm.plain import awkward, repeats
from terrace.llm import suffixes
from terrace.llm.queries import QUERIES
from terrace.sources.tables import table


def expected(rows, length):
    found = repeats([(t or "").encode() for _, t in rows], length)
    return sorted((repr(k), len((t or "").encode()), n, runs, hashlib.sha256(kept).hexdigest()) for (k, t), (n, runs, kept) in zip(rows, found, strict=True))


def result(df):
    return sorted((repr(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.drop("kept").collect())


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert result(QUERIES["op10_suffixes"](spark, sf)) == expected(rows, 400)


def test_awkward(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert result(suffixes.remove_repeats(docs)) == expected(rows, 400)
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0
    assert result(suffixes.remove_repeats(docs.filter("doc_id = 7"))) == expected([(7, "one")], 400)


@pytest.mark.parametrize("seed", range(3))
def test_small_texts_over_many_buckets(spark, seed):
    draw = random.Random(seed)
    letters = ["ab", "abcdef\0", "abcdefghijklmnopqrstuvwxyzé"][seed]
    pool = ["".join(draw.choices(letters, k=draw.randint(20, 160))) for _ in range(6)]
    texts = ["".join(draw.choice(pool) if draw.random() < 0.6 else "".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(draw.randint(0, 8))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(99, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    places = suffixes.marked(docs, "doc_id", "text", 40)
    assert places.count() == len(rows)
    assert result(suffixes.remove_repeats(docs, length=40)) == expected(rows, 40)


@pytest.mark.parametrize("buckets", [1, 2, 7])
def test_buckets(buckets):
    draw = random.Random(buckets)
    for _ in range(15):
        pool = [bytes(draw.choices(b"abc\0", k=draw.randint(10, 90))) for _ in range(5)]
        texts = [b"".join(draw.choice(pool) if draw.random() < 0.7 else bytes(draw.choices(b"abc\0", k=20)) for _ in range(draw.randint(0, 7))) for _ in range(20)]
        rows = [(i, int(a), int(a - lo), t[lo : hi + 32]) for i, t in enumerate(texts) for a, lo, hi in zip(*suffixes.anchors(t, 32), strict=True)]
        if not rows:
            continue
        rows.sort(key=lambda r: (r[3][r[2] :], draw.random()))
        gone = [np.zeros(len(t), dtype=bool) for t in texts]
        named = {}
        for part in np.array_split(np.arange(len(rows)), buckets):
            if len(part):
                mine = [rows[k] for k in draw.sample(part.tolist(), len(part))]
                low, high, edges = suffixes.solve_bucket([r[3] for r in mine], np.array([r[2] for r in mine]), 32)
                for (i, a, _, _), x, y in zip(mine, low, high, strict=True):
                    if x <= y:
                        gone[i][a + x : a + y + 32] = True
                for k, back, _ in edges:
                    i, a, rel, data = mine[k]
                    named.setdefault(data[rel + back : rel + back + 32], []).append((i, a + back))
        for found in named.values():
            for i, p in found if len(found) > 1 else []:
                gone[i][p : p + 32] = True
        assert [int(g.sum()) for g in gone] == [n for n, _, _ in repeats(texts, 32)]


def test_multikey_sort():
    rows = np.random.default_rng(1).integers(0, 3, (500, 6)).astype(np.uint64)
    order = suffixes.multikey_sort(rows)
    assert [tuple(r) for r in rows[order].tolist()] == sorted(tuple(r) for r in rows.tolist())


def test_blocks_of_a_long_text(monkeypatch):
    text = bytes(np.random.default_rng(2).integers(97, 101, 5000).astype(np.uint8))
    whole = suffixes.anchors(text, 64)
    monkeypatch.setattr(suffixes, "BLOCK", 300)
    at, first, last = suffixes.anchors(text, 64)
    starts = [p for a, b in zip(first, last, strict=True) for p in range(a, b + 1)]
    assert starts == list(range(len(text) - 63))
    named = dict(zip([p for a, b in zip(whole[1], whole[2], strict=True) for p in range(a, b + 1)], np.repeat(whole[0], whole[2] - whole[1] + 1), strict=True))
    assert [named[p] for p in starts] == np.repeat(at, last - first + 1).tolist()
