"""Near-duplicate texts by SimHash, linked through an inverted index of fingerprint bytes.

Fingerprints that differ in at most three bits differ in at most three of their eight bytes, so
they share five positional bytes or more. The index lists fingerprints by four positional bytes at a
time: fourteen sets of four positions are enough, since any three positions are missed by one of
them. Within a list the shared positional bytes of a pair are tallied, pairs below five drop out, and
the bits of the others are compared. One byte alone would be a list of a 256th of the corpus, four
make lists that stay short at any size, unless texts are truly alike. Lists longer than ``list_max``
go another exact way: two fingerprints three bits apart meet at a word one bit from the one and two
bits from the other, and a word has at most 2,081 such neighbours, however long the list was.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import slices
from terrace.plans.closure import components
from terrace.session import write_through

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
MIN_SHARED = 5
LIST_MAX = 256
#: Words handled at once of one text.
BLOCK_WORDS = 1 << 18


def position_sets() -> list[tuple[int, ...]]:
    """Sets of four of the eight byte positions, any two with at most two in common; each three positions lie outside one."""
    chosen: list[tuple[int, ...]] = []
    for four in combinations(range(8), 4):
        if all(len(set(four) & set(other)) <= 2 for other in chosen):
            chosen.append(four)
    return chosen


def byte_mask(positions: tuple[int, ...]) -> int:
    return signed(sum(0xFF << (8 * p) for p in positions))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """SimHash of the shingles of a text, repeats included; zero without words."""
    found = text.lower().split()  # bytes: A-Z alone are lowered, and the split is at the six white-space bytes
    if not found:
        return 0
    if len(found) < size:
        found = [b" ".join(found)]
        size = 1
    ones, n = np.zeros(64, dtype=np.int64), len(found) - size + 1
    digest = xxhash.xxh64_digest
    for at in range(0, n, BLOCK_WORDS):
        some = found[at : at + BLOCK_WORDS + size - 1]
        shingles = map(b" ".join, zip(*(some[k:] for k in range(size)), strict=False)) if size > 1 else some
        hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), dtype=np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """``key`` and ``fp`` (the 64 bits as a signed long) of every document; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").fill_null("").cast(pa.large_binary()).to_pylist()
            found = np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found)], ["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp long").withColumnRenamed("key", key)


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes are alike."""
    return ((a ^ b).view(np.uint8).reshape(*np.broadcast(a, b).shape, 8) == 0).sum(axis=-1)


def links_in_list(fps: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one list: (fp, root), the root included."""
    n = len(fps)
    root = np.arange(n)
    for i in range(n - 1):
        rest = fps[i + 1 :]
        near = shared_bytes(rest, fps[i]) >= 8 - max_bits
        if near.any():
            hits = i + 1 + np.flatnonzero(near)
            hits = hits[np.bitwise_count((fps[hits] ^ fps[i]).view(np.uint64)) <= max_bits]
            if len(hits):
                groups = np.append(root[hits], root[i])
                root[np.isin(root, groups)] = groups.min()
    linked = np.bincount(root, minlength=n)[root] > 1
    return list(zip(fps[linked].tolist(), fps[root[linked]].tolist(), strict=True))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, list_max: int = LIST_MAX) -> DataFrame:
    """(``fp``, ``root``) so that fingerprints at ``max_bits`` or fewer are joined through chains of equal roots.

    ``distinct`` has one row a fingerprint in ``fp``. Pairs are never listed: a list of n alike
    fingerprints gives n rows at most.
    """
    if max_bits > MAX_BITS:
        raise ValueError("the position sets hold for three bits")
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("set"), F.col("fp").bitwiseAND(F.lit(byte_mask(p)).cast("long")).alias("bytes"))
            for i, p in enumerate(position_sets())
        ]
    )
    index = distinct.select("fp", F.explode(entries).alias("e")).select("fp", "e.set", "e.bytes")
    sizes = index.groupBy("set", "bytes").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    listed = write_through(index.join(sizes, ["set", "bytes"]), "simhash-lists")
    short = listed.filter(F.col("n") <= list_max).groupBy("set", "bytes").agg(F.sort_array(F.collect_list("fp")).alias("fps"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [p for fps in batch.column(0).to_pylist() for p in links_in_list(np.array(fps, dtype=np.int64), max_bits)]
            yield pa.RecordBatch.from_pydict({"fp": pa.array([p[0] for p in pairs], pa.int64()), "root": pa.array([p[1] for p in pairs], pa.int64())})

    near = short.select("fps").mapInArrow(run, "fp long, root long")
    long = listed.filter(F.col("n") > list_max).select("fp").distinct()
    return near.unionByName(links_by_midpoint(long, max_bits)).distinct()


def links_by_midpoint(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The same for fingerprints of lists of any length, through the words between them."""
    one = (max_bits + 1) // 2 - (max_bits % 2)
    two = max_bits - one
    flips = [(sum(1 << b for b in bits), k <= one) for k in range(two + 1) for bits in combinations(range(64), k)]
    masks = np.array([m for m, _ in flips], dtype=np.uint64)
    close = np.array([c for _, c in flips])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy().view(np.uint64):
                word = (masks ^ fp).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(masks), fp).view(np.int64)), pa.array(word), pa.array(close)], ["fp", "word", "close"]
                )

    met = fps.select("fp").mapInArrow(run, "fp long, word long, close boolean").groupBy("word")
    # any two that meet where one of them is close are within max_bits of that one
    found = met.agg(F.max("close").alias("any"), F.min(F.when(F.col("close"), F.col("fp"))).alias("root"), F.collect_list("fp").alias("fps"))
    return found.filter(F.col("any") & (F.size("fps") > 1)).select(F.explode("fps").alias("fp"), "root")


def labelled(distinct: DataFrame, list_max: int = LIST_MAX) -> DataFrame:
    """``distinct``, one row a fingerprint in ``fp``, with the ``label`` of the component that its links give."""
    pairs = write_through(links(distinct.select("fp"), list_max=list_max), "simhash-links")
    labels = components(pairs, "fp", "root").select(F.col("item").alias("fp"), "label")
    return distinct.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", list_max: int = LIST_MAX) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the smallest key that can be reached over links) of every document.

    Repeated rows stay, each with its component; a document without words has fingerprint zero and
    links like any other; a null key is kept and never names a component. Extra columns are left out.
    """
    marked = write_through(fingerprints(docs, key, text), "simhash")
    distinct = write_through(marked.groupBy("fp").agg(F.min(key).alias("first")), "simhash-distinct")
    joined = labelled(distinct, list_max)
    named = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    by_fp = joined.select("fp", "label").join(named, "label").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(key, "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: that of the smallest key; of repeated rows of that key one stays.

    Documents with a null key are told apart from no other and stay.
    """
    found = near_duplicates(docs, key, text)
    first = found.filter(F.col(key) == F.col("component_id")).select(key).distinct()
    chosen = docs.join(first, key, "left_semi").dropDuplicates([key])
    return chosen.unionByName(docs.filter(F.col(key).isNull()))
