import random
from itertools import combinations

import zstandard

import corpus_pipeline
from tests.llm.plain import awkward
from terrace.llm import near_copies
from terrace.llm.simhash import fingerprint


def plain_shingles(text):
    found = text.lower().split()
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))}


def test_stage_links_at_four_fifths_of_five_word_shingles(spark):
    """Of two texts at 0.8 or more one stays; a text that none is so near to stays."""
    draw = random.Random(3)
    texts = []
    for _ in range(40):
        base = [f"w{draw.randrange(5000)}" for _ in range(300)]
        for changes in (0, 2, 4, 6, 12, 20):
            copy = list(base)
            for at in draw.sample(range(300), changes):
                copy[at] = f"x{draw.randrange(10**6)}"
            texts.append(" ".join(copy))
    sets = [plain_shingles(t) for t in texts]
    share = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for g in range(40) for i, j in combinations(range(6 * g, 6 * g + 6), 2)}
    near = [pair for pair, s in share.items() if s >= 0.8]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()}
    assert sum(i in kept and j in kept for i, j in near) <= 0.02 * len(near) and len(near) > 40
    alone = {i for i in range(len(texts)) if not any(i in pair for pair in near)}
    assert len(alone) > 40 and alone <= kept


def test_large_lists_and_odd_rows(spark):
    base = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join([*base[: i % 7], "other", *base[i % 7 + 1 :]])) for i in range(50)] + [(60, None), (61, ""), (None, " ".join(base)), (62, "too few words")]
    kept = near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr(r["doc_id"]) for r in kept) == ["0", "60", "62", "None"]
    docs = awkward(spark)
    assert near_copies.keep_first(docs).columns == docs.columns and near_copies.keep_first(docs.limit(0)).count() == 0


def test_rows_of_one_key_and_any_column_names(spark):
    """Two texts under one key are told apart; a repeated row stays once; columns keep names, order and types."""
    long = [" ".join(f"{c}{k}" for k in range(60)) for c in "abc"]
    rows = [(1, long[0], 5), (1, long[1], 6), (1, long[1], 6), (2, long[1] + " more", 7), (3, long[2], 8), (None, long[2], 9), (None, long[2], 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket int").selectExpr("bucket", "text", "doc_id", "bucket AS row", "text AS rest", "doc_id AS id", "bucket AS `a.b`")
    kept = near_copies.keep_first(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.bucket, r.text == r.rest) for r in kept.collect()) == [(5, True), (6, True), (8, True), (9, True), (9, True)]


def test_a_list_of_unlike_texts_ends(spark, monkeypatch):
    """Texts that meet in every list without being alike take few rounds, and all stay."""
    monkeypatch.setattr(near_copies, "band_hashes", lambda hashes: [7] if len(hashes) else [])
    rounds = []
    real = near_copies.verified
    monkeypatch.setattr(near_copies, "verified", lambda *a: rounds.append(1) or real(*a))
    rows = [(k, " ".join(f"w{k * 50 + i}" for i in range(20))) for k in range(120)]
    assert near_copies.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).count() == 120
    assert len(rounds) <= 4


def test_blocks_meet_every_hub_of_a_list(spark, monkeypatch):
    """Links of the first round are those of all texts with the four smallest keys, however lists and hubs are cut."""
    draw = random.Random(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(40):
        copy = list(base)
        for at in draw.sample(range(60), k % 4):
            copy[at] = f"x{k}"
        texts.append(" ".join(copy))
    packed = [(k, zstandard.ZstdCompressor().compress(t.encode())) for k, t in enumerate(texts)]
    entries = spark.createDataFrame([(7, k, 40) for k in range(40)] + [(8, k, 3) for k in (5, 9, 30)], "bucket long, id long, n long")
    hubs = spark.createDataFrame([(7, k, 40, k + 1) for k in range(4)] + [(8, 5, 3, 1), (8, 9, 3, 2), (8, 30, 3, 3)], "bucket long, id long, n long, place int")
    sets = [plain_shingles(t) for t in texts]
    met = [(7, i, h) for h in range(4) for i in range(h + 1, 40)] + [(8, 9, 5), (8, 30, 5), (8, 30, 9)]
    want = sorted((b, i, h) for b, i, h in met if len(sets[i] & sets[h]) / len(sets[i] | sets[h]) >= 0.8)
    assert 20 < len(want) < len(met)
    for part_rows, block in ((64, 32), (3, 1), (1, 3)):
        monkeypatch.setattr(near_copies, "PART_ROWS", part_rows)
        monkeypatch.setattr(near_copies, "HUB_BLOCK", block)
        found = near_copies.verified(entries, hubs, spark.createDataFrame(packed, "id long, packed binary"), 4, 0.8)
        assert sorted(map(tuple, found.collect())) == want


def test_fingerprints_link_without_a_common_band(spark, monkeypatch):
    """The stage goes by SimHash links too: near copies at three bits meet by these alone, and unlike texts of one fingerprint stay."""
    monkeypatch.setattr(near_copies, "band_hashes", lambda hashes: [int(hashes.sum() >> 1)] if len(hashes) else [])
    draw = random.Random(11)
    texts = []
    for _ in range(30):
        base = [f"w{draw.randrange(5000)}" for _ in range(300)]
        copy = list(base)
        copy[draw.randrange(300)] = "other"
        texts += [" ".join(base), " ".join(copy)]
    bits = [(fingerprint(texts[i].encode(), 5) ^ fingerprint(texts[i + 1].encode(), 5)).bit_count() for i in range(0, 60, 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()}
    assert kept == {i for i in range(60) if i % 2 == 0 or bits[i // 2] > 3} and len(kept) < 50
    monkeypatch.setattr(near_copies, "fingerprint", lambda text, size: 5)
    assert near_copies.keep_first(docs.filter("doc_id % 2 = 0")).count() == 30
