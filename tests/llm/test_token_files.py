import zlib

import pyarrow.parquet as pq
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.plain import awkward
from terrace.llm import token_files
from terrace.llm.queries import END_ID, QUERIES, tokenizer_path
from terrace.sources.tables import table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


def digest(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def expected(tokenizer, rows):
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(tokenizer, text)
        out.append((key, start, len(ids), digest(ids)))
        start += len(ids)
    return out


def test_query(spark, sf, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in QUERIES["op4_token_files"](spark, sf).orderBy("start").collect()]
    assert got == expected(tokenizer, rows)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.text(alphabet="aB'ßİς.,1 \u00a0\n\u0301<|endoftext|>’sS", max_size=40)), max_size=8))
def test_words_have_the_ids_of_the_text(tokenizer, texts):
    ids = token_files.word_ids(tokenizer_path()).encode(pa.array(texts, pa.string()), END_ID).to_pylist()
    assert ids == [plain(tokenizer, t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="aBéÀß×÷.,!|'1 \u0301\u00a0ſKİ", max_size=30), max_size=4), min_size=1, max_size=4), st.sampled_from([0, 3, 600_000]))
def test_words_of_several_slices(tokenizer, slices, kept_words):
    ids = token_files.WordIds(tokenizer_path(), kept_words)
    for _ in range(2):
        got = ids.encode_parts([pa.array(texts, pa.string()) for texts in slices], END_ID)
        assert [part.to_pylist() for part in got] == [[plain(tokenizer, t) for t in texts] for texts in slices]
        assert len(ids.kept) <= kept_words


def test_a_word_is_encoded_once_in_all_its_forms(tokenizer):
    ids = token_files.WordIds(tokenizer_path())
    texts = ["And and, AND. (and) and!", "and, Andes É é, 1.", "long" * 40]
    assert ids.encode(pa.array(texts), END_ID).to_pylist() == [plain(tokenizer, t) for t in texts]
    assert sorted(map(str, ids.kept)) == sorted(["", "and", "andes", "É", "é", ",", ".", "!", "(and)", "1."])


def test_awkward(spark, tokenizer, tmp_path):
    docs = awkward(spark)
    token_files.write_corpus(docs, str(tmp_path / "c"), tokenizer_path(), END_ID)
    got = token_files.digests(spark, str(tmp_path / "c")).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((repr(k), n, c) for k, _, n, c in expected(tokenizer, rows))
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == list(np.cumsum([0] + [r["n_tokens"] for r in by_start[:-1]]))
    token_files.write_corpus(docs.limit(0), str(tmp_path / "e"), tokenizer_path(), END_ID)
    assert token_files.digests(spark, str(tmp_path / "e")).count() == 0


def test_files_can_be_read_in_part(spark, sf, tmp_path):
    path = str(tmp_path / "c")
    token_files.write_corpus(table(spark, sf, "documents"), path, tokenizer_path(), END_ID)
    file = next((tmp_path / "c" / "data").glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    tokens = next(group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema.startswith("tokens"))
    assert tokens.has_offset_index and tokens.has_column_index
    assert any("DICTIONARY" in e or "DELTA" in e for e in tokens.encodings)
    assert token_files.read_corpus(spark, path, F.col("doc_id") == 7).count() == 1
    scan = token_files.read_index(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids_crc32" not in scan and "tokens:array" not in scan
