import random

from tests.llm.plain import awkward, components, fingerprint
from terrace.llm import simhash
from terrace.llm.queries import QUERIES
from terrace.sources.tables import table


def expected(docs):
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in docs.select("doc_id", "text").collect()]
    least = components(rows)
    return sorted((repr(k), f"{f:016x}", least[f]) for k, f in rows)


def result(df):
    found = df.select("doc_id", simhash.hex_fingerprint().alias("f"), "component_id").collect()
    return sorted((repr(r["doc_id"]), r["f"], r["component_id"]) for r in found)


def test_query(spark, sf):
    rows = QUERIES["op3_simhash"](spark, sf).collect()
    assert sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows) == expected(table(spark, sf, "documents"))


def test_awkward(spark):
    assert result(simhash.near_duplicates(awkward(spark))) == expected(awkward(spark))
    assert simhash.near_duplicates(awkward(spark).limit(0)).count() == 0


def test_position_sets_miss_any_three():
    from itertools import combinations

    sets = simhash.position_sets()
    assert len(sets) == 14 and all(any(not set(three) & set(s) for s in sets) for three in combinations(range(8), 3))


def linked(spark, fps, list_max):
    from terrace.plans.closure import components as closed

    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    labels = {r["item"]: r["label"] for r in closed(simhash.links(df, list_max=list_max), "fp", "root").collect()}
    groups = {}
    for f in fps:
        groups.setdefault(labels.get(simhash.signed(f), simhash.signed(f)), set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_both_ways_of_lists_find_all_links(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(6)] + [0]
    fps = {c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for c in centres for _ in range(12)}
    fps |= {draw.getrandbits(64) for _ in range(40)}
    least = components([(f, f) for f in fps])
    groups = {}
    for f in fps:
        groups.setdefault(least[f], set()).add(f)
    want = sorted(map(sorted, groups.values()))
    assert linked(spark, sorted(fps), 256) == want
    assert linked(spark, sorted(fps), 1) == want
    assert linked(spark, sorted(fps), 4) == want


def test_one_of_a_group_stays(spark):
    base = " ".join(f"word{i}" for i in range(400))
    docs = spark.createDataFrame([(3, base, "x"), (2, base, "y"), (2, base, "y"), (5, "other text here now", "z"), (None, base, "n")], "doc_id long, text string, source string")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == ["2", "5", "None"]
