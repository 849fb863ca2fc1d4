"""Two tokenizers over the same bytes, against all pairs of tokens of whole texts."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import alignment
from terrace.llm.queries import QUERIES, tokenizer_path

from .plain import awkward

rising = st.lists(st.integers(1, 60), unique=True).map(sorted)


@given(rising, rising)
def test_gallop(a, b):
    assert alignment.gallop(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)).tolist() == [sum(y < x for y in b) for x in a]


def test_gallop_over_strides():
    draw = np.random.default_rng(3)
    for n, m in ((1000, 5000), (300, 300), (65, 70_000), (64, 1)):
        a, b = (np.sort(draw.choice(100_000, size, replace=False)) for size in (n, m))
        assert (alignment.gallop(a, b) == np.searchsorted(b, a)).all()


@given(rising, rising, st.integers(61, 70))
def test_align(a, b, end):
    a, b = [*a, end], [*b, end]
    ends, links = alignment.align(a, b)
    spans = lambda ends: list(zip([0, *ends[:-1]], ends))
    assert sorted(map(tuple, links.tolist())) == [(i, j) for i, (p, q) in enumerate(spans(a)) for j, (r, s) in enumerate(spans(b)) if p < s and r < q]
    assert list(map(tuple, ends.tolist())) == [(a.index(x) + 1, b.index(x) + 1) for x in sorted({*a} & {*b})]
    assert [len(x) for x in alignment.align([], [])] == [0, 0]


def plain(rows):
    """Whole texts, all pairs of tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    letters, found, held = alignment.byte_letters(), [], Counter()
    assert len(letters) == 256
    for key, text in rows:
        ids_a, ids_b = ([], []) if not text else (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text))
        tok_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        tok_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        if text and not b"".join(tok_a) == b"".join(tok_b) == f" {text}".encode():
            ids_a, ids_b, tok_a, tok_b = [], [], [], []
        places = []
        for tokens in (tok_a, tok_b):
            at = 0
            places.append([(at, at := at + len(t)) for t in tokens])
        ends = sorted({q for _, q in places[0]} & {q for _, q in places[1]})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, (p, q) in zip(ids, at) if low <= p and q <= end) for ids, at in zip((ids_a, ids_b), places)))
            low = end
        links = [(x, y) for x, (p, q) in zip(ids_a, places[0]) for y, (r, s) in zip(ids_b, places[1]) if p < s and r < q]
        held.update(set(links))
        found.append((key, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(
        ((k, na, nb, ng, len(ln), sum(held[p] == most[p[0]] for p in ln), sum(held[p] for p in ln), sha) for k, na, nb, ng, ln, sha in found), key=str
    )


def got(spark, docs):
    found = alignment.align_texts(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return sorted((tuple(r) for r in found.collect()), key=str)


ODD = [
    "a", " a", "a ", " ", "  ", "a  b", "a\n b", "a \n\n b ", "\x1f a\x1f b", "don't  we're", "<|endoftext|> <s></s> <0x0A> <unk>", "x  y z",
    "naïve 漢字かな 😀👍🏽", "a▁b", "▁", "tab\t\ttab", "1234567 3.14", "=" * 300, "   " * 9, "ﬁ ½ é", "a\x00b \x00 c", "\r\n x\r\n", "﻿bom",
]


def test_odd_texts(spark):
    rows = [(k, t) for k, t in enumerate([*ODD, None, "", *ODD[:3]])] + [(None, "a b"), (1, "a b")]
    assert got(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows)


def test_awkward(spark):
    docs = awkward(spark).filter("length(text) < 1000 OR text IS NULL").selectExpr("*", "doc_id AS pair", "text AS row", "lang AS n_a")
    assert got(spark, docs) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert got(spark, docs.limit(0)) == []
    assert len(got(spark, awkward(spark))) == 12


@pytest.fixture(scope="module")
def tokens():
    return alignment.Tokens(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@settings(deadline=None)
@given(text=st.text(st.sampled_from("ab1'. \n\t\u00a0é漢▁"), max_size=30))
def test_pieces_are_whole_texts(tokens, text):
    pieces = tokens.cut(text)
    if "▁" in text:
        assert any(x is None for x in tokens.aligned(pieces))
        return
    known = tokens.aligned(pieces)
    whole: dict = {"": (0, 0, 0, "", b"")}
    if text:
        tokens.encode([f" {text}"], whole)
    counts, written, links = whole[f" {text}" if text else ""][:3], *whole[f" {text}" if text else ""][3:]
    assert [sum(k[c] for k in known) for c in range(3)] == list(counts)
    assert ";".join(k[3] for k in known) == written and b"".join(k[4] for k in known) == links


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect() if len(r.text) < 2500]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(spark, docs) == plain(rows)
    found = QUERIES["op12_alignment"](spark, sf)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("at_once", [1, 3])
def test_kept_pieces(monkeypatch, tokens, at_once):
    monkeypatch.setattr(alignment, "ENCODE_AT_ONCE", at_once)
    monkeypatch.setattr(alignment, "KEPT_PIECES", 2)
    pieces = tokens.cut("one two three two one four")
    assert tokens.aligned(pieces) == [tokens.aligned([p])[0] for p in pieces]
