"""Token ids in Parquet files that can be read in part.

A corpus is a folder with two tables. ``data`` has a row per document, in ascending order of
document id over the files: ``doc_id``, ``part``, ``n_tokens`` and the list column ``tokens``. Ids
repeat, so ``tokens`` is dictionary encoded (a file whose dictionary outgrows its page falls back
to delta encoding, as the second Parquet page format gives it); row groups and pages are kept
small, and the writer adds page indexes, so that a reader who wants a few documents or only their
lengths touches a few pages. ``parts`` has the number of tokens ahead of each file.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.arrays import slices, words
from terrace.session import write_table

#: How the files are laid out.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(256 << 10),
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "compression": "zstd",
}
#: Text bytes whose distinct words are looked up at once; ids are laid out by smaller slices.
GROUP_BYTES = 16 << 20
#: Words a worker keeps the ids of by default, plain ones in lower case and without marks; further words are encoded again when they come up.
KEPT_WORDS = 600_000
#: Longer words are not kept: they seldom come again and could fill a worker.
KEPT_BYTES = 128
#: Words that are one run of letters, with or without a run of marks behind: one or two pieces for the tokenizer.
MARKS = ".,;:!?|*$%&#)"
LETTERS = "".join(chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7))
PLAIN = rf"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{MARKS}]*$"
_LOADED: dict[tuple[str, int], WordIds] = {}


def lengths(texts: pa.Array) -> np.ndarray:
    return pc.binary_length(texts).to_numpy(zero_copy_only=False)


def spans(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ``sizes`` elements from each of ``begins`` on, one span after the other."""
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int64) + np.repeat(begins - first, sizes)


class WordIds:
    """Ids by word. The tokenizer drops white space and no piece of it spans any, so ids of a text are those of its words."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the tokenizer lower-cases and does nothing else to words of a to z, so these go to its merges as they are
        self.lower = Tokenizer(self.tokenizer.model)
        self.lower.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # words kept, how many ids each has, and the ids one after the other
        self.kept, self.kept_words = pa.array([], pa.large_string()), kept_words
        self.sizes, self.pool = np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def fresh(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words and parts of words: the order they are taken in, how many each has, and the ids one after the other."""
        is_lower = pc.match_substring_regex(units, "^[a-z]+$")
        lower, other = units.filter(is_lower), units.filter(pc.invert(is_lower))
        order = np.argsort(~is_lower.to_numpy(zero_copy_only=False), kind="stable")
        sizes, pool = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype="<u4")]
        texts = lower.to_pylist()
        # many runs of a to z to a call: they are told apart by the tokens that close them
        for at in range(0, len(texts), 200):
            some = texts[at : at + 200]
            ids = np.array(self.lower.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the tokenizer does not close each word with one token")
            sizes.append(np.diff(ends, prepend=0))
            pool.append(ids)
        texts = other.to_pylist()
        for at in range(0, len(texts), 2000):
            coded = [one.ids for one in self.tokenizer.encode_batch_fast(texts[at : at + 2000], add_special_tokens=False)]
            sizes.append(np.array(list(map(len, coded)), dtype=np.int64))
            pool.append(np.array(list(chain.from_iterable(coded)), dtype="<u4"))
        return order, np.concatenate(sizes), np.concatenate(pool)

    def look_up(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids of all one after the other. A plain word has those of its letters and those of its marks."""
        simple = pc.match_substring_regex(distinct, PLAIN)
        plain = distinct.filter(simple)
        stems = pc.ascii_rtrim(pc.ascii_lower(plain), MARKS).dictionary_encode()
        marks = pc.utf8_ltrim(plain, LETTERS).dictionary_encode()
        units = pa.concat_arrays([stems.dictionary, marks.dictionary, distinct.filter(pc.invert(simple))])
        at = pc.index_in(units, value_set=self.kept)
        place, missing = at.fill_null(0).to_numpy().astype(np.int64), np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        order, sizes, pool = self.fresh(units.take(missing))
        missing = missing[order]
        place[missing] = len(self.kept) + np.arange(len(missing))
        # the last unit has no ids
        sizes, pool = np.concatenate((self.sizes, sizes, [0])), np.concatenate((self.pool, pool))
        # two units a word: letters and marks, or the whole word and nothing
        simple = simple.to_numpy(zero_copy_only=False)
        parts = np.full((len(simple), 2), len(sizes) - 1)
        parts[simple, 0] = place[stems.indices.to_numpy()]
        parts[simple, 1] = place[len(stems.dictionary) + marks.indices.to_numpy().astype(np.int64)]
        parts[~simple, 0] = place[len(stems.dictionary) + len(marks.dictionary) :]
        begins = np.cumsum(sizes) - sizes
        found = sizes[parts].sum(axis=1), pool[spans(begins[parts].ravel(), sizes[parts].ravel())]
        room = missing[lengths(units.take(missing)) <= KEPT_BYTES][: max(self.kept_words - len(self.kept), 0)]
        if len(room):
            self.kept = pa.concat_arrays([self.kept, units.take(room)])
            new = place[room]
            self.sizes, self.pool = np.concatenate((self.sizes, sizes[new])), np.concatenate((self.pool, pool[spans(begins[new], sizes[new])]))
        return found

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        """A list of ids for each text, ``end_id`` last."""
        return next(self.encode_parts([texts], end_id))

    def encode_parts(self, parts: list[pa.Array], end_id: int) -> Iterator[pa.Array]:
        """The lists of each of some arrays of texts; the distinct words of all are looked up together."""
        flats, counts = zip(*map(words, parts), strict=True)
        coded = pa.concat_arrays(flats).dictionary_encode()
        sizes, pool = self.look_up(coded.dictionary)
        begins = np.cumsum(sizes) - sizes
        pool = np.append(pool, np.uint32(end_id)).astype(np.int32)
        start = 0
        for flat, count in zip(flats, counts, strict=True):
            at = coded.indices.slice(start, len(flat)).to_numpy(zero_copy_only=False)
            start += len(flat)
            # the end id follows each text, as a word of its own
            ends = np.cumsum(count)
            length = np.insert(sizes[at], ends, 1)
            ids = pool[spans(np.insert(begins[at], ends, len(pool) - 1), length)]
            stops = np.cumsum(length)[ends + np.arange(len(ends))]
            offsets = np.concatenate(([0], stops)).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def word_ids(path: str, kept_words: int = KEPT_WORDS) -> WordIds:
    """The tokenizer of this worker; one at a time."""
    if (path, kept_words) not in _LOADED:
        _LOADED.clear()
        _LOADED[path, kept_words] = WordIds(path, kept_words)
    return _LOADED[path, kept_words]


def encoded(rows: DataFrame, tokenizer: str, end_id: int, kept_words: int = KEPT_WORDS) -> DataFrame:
    """``key``, ``tie``, ``n_tokens`` and ``tokens`` of rows of ``key``, ``tie`` and ``text``, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer, kept_words)
        for group in slices(batches, limit=GROUP_BYTES):
            parts = list(slices([group]))
            for part, tokens in zip(parts, ids.encode_parts([p.column("text") for p in parts], end_id), strict=True):
                count = pc.list_value_length(tokens).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("tie"), count, tokens], ["key", "tie", "n_tokens", "tokens"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, tie long, n_tokens long, tokens array<int>")


def write_corpus(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
                 kept_words: int = KEPT_WORDS) -> None:
    """Write the documents in ascending order of ``key`` (nulls first; equal keys by a hash of the text).

    The key and the hash are the ranges' bounds, so that a key that very many rows share is split too.
    Extra columns are left out. An empty table gives a folder with no rows. ``kept_words`` bounds the
    memory of a worker and changes no result.
    """
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("tie"), F.col(text).cast("string").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie")
    tokens = encoded(ranged, tokenizer, end_id, kept_words).select(
        F.col("key").alias("doc_id"), F.spark_partition_id().alias("part"), "tie", "n_tokens", "tokens"
    )
    tokens.write.options(**LAYOUT).parquet(f"{path}/data")
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{path}/data").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # one row for each file
    ahead = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    write_table(sizes.select("part", F.coalesce(ahead, F.lit(0)).alias("ahead")), f"{path}/parts")


def read_corpus(spark: SparkSession, path: str, wanted: Column | None = None) -> DataFrame:
    """``doc_id``, ``part``, ``n_tokens``, ``tokens`` of the documents that ``wanted`` picks; the filter reaches the page index."""
    data = spark.read.parquet(f"{path}/data")
    return data if wanted is None else data.filter(wanted)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` of each document: the token column is not read."""
    data = spark.read.parquet(f"{path}/data").select("doc_id", "part", "tie", "n_tokens")
    return starts(data, spark, path).drop("part", "tie")


def starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``rows`` with ``start``, the number of tokens ahead of each document. One file is one window."""
    parts = spark.read.parquet(f"{path}/parts").withColumnRenamed("part", "__part")
    within = Window.partitionBy("part").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumn("__in", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    joined = joined.join(parts, F.col("part") == F.col("__part"))
    return joined.withColumn("start", F.col("ahead") + F.col("__in")).drop("__in", "__part", "ahead")


def checksums(data: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``tie``, ``n_tokens`` and ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            offsets = tokens.offsets.to_numpy()
            ids = np.ascontiguousarray(tokens.values.to_numpy(zero_copy_only=False)).astype("<u4").tobytes()
            view = memoryview(ids)
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sums, pa.int64())], ["doc_id", "part", "tie", "n_tokens", "ids_crc32"])

    kind = data.schema["doc_id"].dataType.simpleString()
    rows = data.select("doc_id", "part", "tie", "n_tokens", "tokens")
    return rows.mapInArrow(run, f"doc_id {kind}, part int, tie long, n_tokens long, ids_crc32 long")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document read back: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    return starts(checksums(read_corpus(spark, path)), spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
