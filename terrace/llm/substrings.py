"""Word sequences repeated across documents: seeds from winnowed anchors, extended both ways.

A window is ``least`` words in a row of one document. Of the hashes of ``SEED_WORDS`` words inside a
window the smallest is its anchor, so equal windows have equal anchors at the same place, and an anchor
stands for a run of windows. Documents are joined on anchors; those of one text only drop out. Around a
seed that several texts hold, the match is extended to both sides as far as the anchor stands for:
seeds with all the same words around them are one class, and the class of a smaller key covers the whole
run in the others. Where the words around a seed differ, the runs left over are compared window by
window. Neighbouring windows add up to maximal repeats. Copies meet as classes, never as pairs, and a
seed that very many texts hold is counted before it is moved.

Hashes of 128 bits decide: a window is told by its anchor and a second hash of its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import slices, words
from terrace.llm.suffixes import sliding_min
from terrace.session import discard, scratch_path, write_table

LEAST, SEED_WORDS, HASH_SEED = 13, 5, 42
#: Words whose anchors are sought at once.
BLOCK = 1 << 18
EMPTY = hashlib.sha256(b"").digest()
_draw = np.random.default_rng(HASH_SEED)
SEED_STEPS, WINDOW_STEPS = (_draw.integers(0, 1 << 63, 256, dtype=np.uint64) << np.uint64(1) | np.uint64(1) for _ in range(2))


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word; each distinct word is hashed once."""
    if not len(flat):
        return np.zeros(0, dtype=np.uint64)
    coded = flat.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w, HASH_SEED) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return known[np.asarray(coded.indices)]


def rolled(hashes: np.ndarray, size: int, steps: np.ndarray) -> np.ndarray:
    """A hash of the ``size`` words that start at each word."""
    n = len(hashes) - size + 1
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += hashes[k : k + n] * steps[k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(27))


def runs(hashes: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of texts whose words lie one after the other: anchor hash, number of the text, first window, windows."""
    text_of = np.repeat(np.arange(len(counts)), counts)
    found = []
    for at in range(0, max(len(hashes) - least + 1, 0), BLOCK):
        part = hashes[at : at + BLOCK + least - 1]
        n = len(part) - least + 1
        smallest = sliding_min(rolled(part, SEED_WORDS, SEED_STEPS), least - SEED_WORDS + 1)
        here = text_of[at : at + n]
        inside = here == text_of[at + least - 1 : at + least - 1 + n]
        new = np.concatenate(([True], (smallest[1:] != smallest[:-1]) | (here[1:] != here[:-1])))
        first = np.flatnonzero(new & inside)
        # a run ends where the next one begins or where its text has no further window
        ends = np.flatnonzero(np.concatenate((new[1:] | ~inside[1:], [True])) & inside)
        found.append((smallest[first], here[first], at + first, ends - first + 1))
    if not found:
        return np.zeros(0, dtype=np.uint64), *(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    """One list for each of ``n`` owners; ``owner`` is sorted."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def anchored(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """``key``, ``sha`` and compressed bytes of the words joined by one space, ``n_words`` and the distinct anchors of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches):
            texts = batch.column("text")
            flat, counts = words(texts)
            hashes, owner, _, _ = runs(word_hashes(flat), counts, least)
            by = np.lexsort((hashes, owner))
            hashes, owner = hashes[by], owner[by]
            new = np.concatenate((np.ones(min(len(by), 1), dtype=bool), (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
            joined = [b" ".join((t or "").encode().split()) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([hashlib.sha256(t).digest() for t in joined], pa.binary()),
                    pa.array([pack(t) if n >= least else None for t, n in zip(joined, counts.tolist(), strict=True)], pa.binary()),
                    pa.array(counts.astype(np.int64)),
                    lists(hashes[new].view(np.int64), owner[new], len(texts)),
                ],
                ["key", "sha", "packed", "n_words", "anchors"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, sha binary, packed binary, n_words long, anchors array<long>")


def seeded(texts: DataFrame, least: int) -> DataFrame:
    """The shared anchors of each text: ``tid``, ``key``, ``seed``, ``start`` of its first window, ``windows`` (their
    hashes) and ``around``, a hash of all words that the anchor stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", 1 << 19):
            flat, counts = words(pa.array([unpack(p) for p in batch.column("packed").to_pylist()], pa.large_binary()).cast(pa.large_string()))
            hashes = word_hashes(flat)
            seeds, owner, first, n = runs(hashes, counts, least)
            shared = np.unique(np.asarray(batch.column("seeds").flatten()))
            hit = np.isin(seeds.view(np.int64), shared)
            seeds, owner, first, n = seeds[hit], owner[hit], first[hit], n[hit]
            if not len(seeds):
                continue
            windows = rolled(hashes, least, WINDOW_STEPS)
            ends = np.cumsum(n)
            flat_windows = windows[np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(first, n)]
            body, at = memoryview(flat_windows.tobytes()), np.concatenate(([0], ends)) * 8
            around = [xxhash.xxh64_intdigest(body[a:b], HASH_SEED) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            begins = np.cumsum(counts) - counts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("tid").take(pa.array(owner)),
                    batch.column("key").take(pa.array(owner)),
                    pa.array(seeds.view(np.int64)),
                    pa.array((first - begins[owner]).astype(np.int32)),
                    pa.array(np.array(around, dtype=np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat_windows.view(np.int64))),
                ],
                ["tid", "key", "seed", "start", "around", "windows"],
            )

    kind = texts.schema["key"].dataType.simpleString()
    return texts.select("tid", "key", "packed", "seeds").mapInArrow(run, f"tid long, key {kind}, seed long, start int, around long, windows array<long>")


def classes(seen: DataFrame) -> DataFrame:
    """``seed``, ``around``, ``first`` (the smallest key) and ``ways`` (classes of the seed)."""
    named = seen.groupBy("seed", "around").agg(F.min("key").alias("first"))
    return named.join(named.groupBy("seed").agg(F.count(F.lit(1)).alias("ways")), "seed")


def extended(seen: DataFrame, told: DataFrame) -> DataFrame:
    """The occurrences of seeds that a smaller key covers as a whole (``windows`` is null), and those that speak for
    their class where a seed has several."""
    met = seen.join(told.hint("shuffle_hash"), ["seed", "around"])
    later = F.col("key") > F.col("first")
    rest = F.when(~later, F.col("windows")).alias("windows")
    return met.filter(later | (F.col("ways") > 1)).select("tid", "key", "seed", "start", F.size("windows").alias("n"), rest)


def repeats(met: DataFrame, least: int) -> DataFrame:
    """(``tid``, ``start``, ``end``) stretches of words that also start in a text of a smaller key; they may overlap."""
    whole = met.filter(F.col("windows").isNull()).select("tid", "start", (F.col("start") + F.col("n") + least - 1).alias("end"))
    single = met.filter(F.col("windows").isNotNull()).select("tid", "key", "seed", "start", F.posexplode("windows").alias("step", "window"))
    earliest = single.groupBy("seed", "window").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first < last").drop("last")
    later = single.join(earliest.hint("shuffle_hash"), ["seed", "window"]).filter(F.col("key") > F.col("first"))
    return whole.unionByName(later.select("tid", (F.col("start") + F.col("step")).alias("start"), (F.col("start") + F.col("step") + least).alias("end")))


def cut_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``sha``, ``n_removed``, ``repeats`` (maximal, in words) and ``kept`` words of the texts that have spans."""
    per_text = spans.groupBy("tid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", 1 << 19):
            rows = []
            for sha, body, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                merged: list[list[int]] = []
                for s in found:
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                every, kept, at = unpack(body).split(), [], 0
                for start, end in merged:
                    kept += every[at:start]
                    at = end
                rows.append((sha, sum(b - a for a, b in merged), [{"start": a, "end": b} for a, b in merged], b" ".join(kept + every[at:])))
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            kinds = [pa.binary(), pa.int64(), span, pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["sha", "n_removed", "repeats", "kept"])

    joined = texts.select("tid", "sha", "packed").join(per_text, "tid").select("sha", "packed", "spans")
    return joined.mapInArrow(run, "sha binary, n_removed long, repeats array<struct<start:int,end:int>>, kept binary")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``kept_sha256``, ``repeats`` and ``kept`` of every document.

    A word goes if it lies in ``least`` words in a row that also start in a document of a smaller key.
    ``repeats`` are the maximal stretches removed, as word numbers; ``kept`` holds the words that remain,
    joined by one space, and both are null where the text stays as it is. Texts alike but for white space
    are copies: that of the smallest key is cut like any other, the rest loses all. Documents of one key
    never cut each other. A null key is smaller than none: such rows stay whole and cut nothing. Null
    and empty texts have no words; repeated rows are kept; extra columns are left out.
    """
    if not SEED_WORDS < least <= len(WINDOW_STEPS):
        raise ValueError(f"least must be above {SEED_WORDS}, and {len(WINDOW_STEPS)} at most")
    spark = docs.sparkSession
    paths = {name: scratch_path(spark, f"substring-{name}") for name in ("read", "rows", "distinct", "shared", "hits", "texts", "seen", "classes", "met", "spans")}
    read = write_table(anchored(docs, key, text, least).withColumn("tid", F.monotonically_increasing_id()), paths["read"])
    rows = write_table(read.select("key", "sha", "n_words"), paths["rows"])
    once = read.filter((F.col("n_words") >= least) & F.col("key").isNotNull()).groupBy("sha")
    one = once.agg(F.min(F.struct("key", "tid")).alias("one"), F.count(F.lit(1)).alias("copies"))
    distinct = write_table(one.select("sha", F.col("one.key").alias("first"), "one.tid", "copies"), paths["distinct"])
    seeds = read.join(distinct.select("tid"), "tid", "left_semi").select("tid", F.explode("anchors").alias("seed"))
    # a text names each of its anchors once
    shared = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("seed")
    shared = write_table(shared, paths["shared"])
    hits = seeds.join(shared.hint("shuffle_hash"), "seed").groupBy("tid").agg(F.collect_list("seed").alias("seeds"))
    hits = write_table(hits, paths["hits"])
    texts = write_table(read.select("tid", "key", "sha", "packed").join(hits, "tid"), paths["texts"])
    discard(spark, paths["read"])
    for name in ("shared", "hits"):
        discard(spark, paths[name])
    seen = write_table(seeded(texts, least), paths["seen"])
    told = write_table(classes(seen), paths["classes"])
    met = write_table(extended(seen, told), paths["met"])
    for name in ("seen", "classes"):
        discard(spark, paths[name])
    spans = write_table(repeats(met, least), paths["spans"])
    discard(spark, paths["met"])
    cuts = cut_texts(texts, spans).withColumn("kept_sha", F.unhex(F.sha2("kept", 256)))
    named = distinct.select("sha", F.col("first").alias("__first"), "copies").join(cuts, "sha", "left").filter("copies > 1 OR n_removed > 0")
    out = rows.select("key", "sha", "n_words").join(named, "sha", "left")
    copy = F.coalesce(F.col("key") > F.col("__first"), F.lit(False))
    cut = F.col("n_removed").isNotNull() & F.col("key").isNotNull()
    all_words = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return out.select(
        F.col("key").alias(key),
        "n_words",
        F.when(copy, F.col("n_words")).when(cut, F.col("n_removed")).otherwise(0).cast("long").alias("n_removed"),
        F.lower(F.hex(F.when(copy, F.lit(EMPTY)).when(cut, F.col("kept_sha")).otherwise(F.col("sha")))).alias("kept_sha256"),
        F.when(copy, all_words).when(cut, F.col("repeats")).alias("repeats"),
        F.when(copy, F.lit(b"")).when(cut, F.col("kept")).alias("kept"),
    )
