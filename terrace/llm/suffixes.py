"""Bytes covered by a long string that also starts elsewhere, found with a sparse suffix array.

Every stretch of ``length`` bytes has an anchor in its first half: the place of the smallest hash of
eight bytes there. Equal stretches have their anchors at the same place, so it is enough to sort the
suffixes that start at anchors, about one in a hundred. Anchors whose next ``length // 2 + 1`` bytes
are found once only cannot be part of a repeat and drop out before anything is moved. The suffixes
left are dealt out by ranges of their leading bytes, with splitters that Spark samples; equal suffixes
are told apart by their place, so a passage that very many texts share is split over tasks as well.
Each bucket is sorted locally by multikey quicksort, eight bytes a token: runs that are alike so far
are sorted by their next token. Common prefixes of neighbours give the stretches that are alike to the
right of the anchors, the same sort of the reversed bytes gives those to the left, and a stretch
repeats where both agree. Runs at the ends of a bucket may go on in the next one, so the digests of
their stretches are compared across buckets.
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

from terrace.llm.arrays import slices
from terrace.session import write_through

LENGTH = 400
#: Bytes of a text whose anchors are sought at once.
BLOCK = 1 << 20
#: Bytes of context that a bucket should hold.
BUCKET_BYTES = 16 << 20
GRAM = 8
EMPTY = hashlib.sha256(b"").digest()
LINK = "tid long, start int, end int"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the eight bytes that start at each byte."""
    n = len(data) - GRAM + 1
    grams = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        grams |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    grams *= np.uint64(0x9E3779B97F4A7C15)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    return grams


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    square = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    square[: len(values)] = values
    square = square.reshape(rows, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of the stretches that it stands for; each start has one anchor."""
    half = length // 2
    data = np.frombuffer(text, dtype=np.uint8)
    starts = len(data) - length + 1
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = min(BLOCK, 1 << 19)
    place = np.uint64((1 << 20) - 1)
    for at in range(0, max(starts, 0), step):
        n = min(step, starts - at)
        hashes = gram_hashes(data[at : at + n + half - 1 + GRAM - 1])
        # the place decides between equal hashes: the first one stands
        marked = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        least = sliding_min(marked, half)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((first[1:] - 1, [n - 1]))
        found.append((at + (least[first] & place).astype(np.int64), at + first, at + last))
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def multikey_sort(tokens: np.ndarray) -> np.ndarray:
    """Order of the rows of a table of tokens: runs alike so far are sorted by their next token."""
    order = np.arange(len(tokens))
    open_rows, run = order.copy(), np.zeros(len(order), dtype=np.int64)
    for level in range(tokens.shape[1]):
        if not len(open_rows):
            break
        token = tokens[order[open_rows], level]
        by = np.lexsort((token, run))
        order[open_rows] = order[open_rows[by]]
        token, run = token[by], run[by]
        differs = np.concatenate(([True], (token[1:] != token[:-1]) | (run[1:] != run[:-1])))
        run = np.cumsum(differs)
        alone = differs & np.concatenate((differs[1:], [True]))
        open_rows, run = open_rows[~alone], run[~alone]
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row in order shares with the one ahead of it; zero for the first."""
    out = np.zeros(len(order), dtype=np.int64)
    for at in range(1, len(order), 20_000):
        here, ahead = order[at : at + 20_000], order[at - 1 : at - 1 + len(order[at : at + 20_000])]
        differ = rows[here] != rows[ahead]
        out[at : at + len(here)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def as_tokens(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(">u8").astype(np.uint64)


def padded(data: bytes, begins: np.ndarray, sizes: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of ``width`` bytes read from ``begins`` on, forwards or backwards, zero behind their sizes."""
    flat = np.frombuffer(data + b"\0", dtype=np.uint8)
    out = np.zeros((len(begins), width), dtype=np.uint8)
    for at in range(0, len(begins), 20_000):
        some = slice(at, at + 20_000)
        inside = np.arange(width)[None, :] < sizes[some, None]
        places = np.where(inside, begins[some, None] + step * np.arange(width)[None, :], len(flat) - 1)
        out[some] = flat[places]
    return out


def solve_bucket(contexts: list[bytes], rel: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, list]:
    """For each context, first and last start of its repeated stretches (relative to the anchor, first > last
    where none is), and the stretches of the runs at both ends: (context, start, is it repeated here)."""
    n, half = len(contexts), length // 2
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    data = b"".join(contexts)
    right = padded(data, base + rel, sizes - rel, -(-length // GRAM) * GRAM, 1)
    order = multikey_sort(as_tokens(right))
    shared = common_prefixes(right, order)
    least = length - half + 1
    joined = np.concatenate((shared[1:] >= least, [False])) | (shared >= least)
    run = np.cumsum(shared < least)
    edge = (run == run[0]) | (run == run[-1])
    # contexts alone in their run and not at an end have no equal
    keep = joined | edge
    # a neighbour that is dropped shares too little to matter
    order, shared, edge = order[keep], shared[keep], edge[keep]
    left = padded(data, (base + rel - 1)[order], rel[order], -(-half // GRAM) * GRAM, -1)
    left_order = multikey_sort(as_tokens(left))
    left_shared = common_prefixes(left, left_order)
    to_left, to_right = rel[order], (sizes - rel)[order]
    low, high = np.full(n, 1, dtype=np.int64), np.full(n, -length, dtype=np.int64)
    edges = []
    for back in range(half):
        valid = np.flatnonzero((to_left >= back) & (to_right >= length - back))
        if not len(valid):
            continue
        right_class = np.cumsum(shared < length - back)
        left_class = np.empty(len(order), dtype=np.int64)
        left_class[left_order] = np.cumsum(left_shared < back)
        name = (right_class * (len(order) + 1) + left_class)[valid]
        by = np.argsort(name, kind="stable")
        differs = np.concatenate(([True], name[by][1:] != name[by][:-1]))
        twin = np.empty(len(by), dtype=bool)
        twin[by] = ~(differs & np.concatenate((differs[1:], [True])))
        rows = order[valid[twin]]
        low[rows] = np.minimum(low[rows], -back)
        high[rows] = np.maximum(high[rows], -back)
        # one of each class tells the other buckets
        for k in by[differs & edge[valid[by]]]:
            edges.append((int(order[valid[k]]), -back, bool(twin[k])))
    return low, high, edges


def encode_places(at: np.ndarray, first: np.ndarray, last: np.ndarray, half: int) -> np.ndarray:
    """Anchor and the distances to its first and last start as one number."""
    return (at * half + (at - first)) * half + (at - last)


def decode_place(place: int, half: int) -> tuple[int, int, int]:
    rest, to_last = divmod(place, half)
    at, to_first = divmod(rest, half)
    return at, at - to_first, at - to_last


def marked(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``key``, ``sha``, ``n_bytes`` and the anchors of each document, with a hash of the bytes that all its stretches share."""
    half = length // 2
    least = length - half + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches):
            texts = batch.column("text").fill_null("").cast(pa.large_binary()).to_pylist()
            found = [anchors(t, length) for t in texts]
            cores = [digest(t[a : a + least]) for t, (at, _, _) in zip(texts, found, strict=True) for a in at.tolist()]
            counts = np.cumsum([0] + [len(x[0]) for x in found])
            places = np.concatenate([encode_places(*x, half) for x in found])
            inner = pa.StructArray.from_arrays([pa.array(places), pa.array(np.array(cores, dtype=np.uint64).view(np.int64))], ["place", "core"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), inner),
                ],
                ["key", "sha", "n_bytes", "anchors"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, sha binary, n_bytes long, anchors array<struct<place:long,core:long>>")


def packed(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``key``, ``sha`` and the compressed bytes of the texts that are long enough: they are moved once or twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            shas = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), shas, pa.array([pack(t) for t in texts], pa.binary())], ["key", "sha", "packed"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).filter(F.octet_length("text") >= length)
    return rows.mapInArrow(run, f"key {kind}, sha binary, packed binary")


def distinct_texts(places: DataFrame, length: int) -> DataFrame:
    """``tid``, ``sha``, ``key`` of one row and ``anchors`` of every distinct text that is long enough."""
    once = places.filter(F.col("n_bytes") >= length).groupBy("sha").agg(F.min("key").alias("key"), F.first("anchors").alias("anchors"))
    return once.select(F.monotonically_increasing_id().alias("tid"), "sha", "key", "anchors")


def candidates(docs: DataFrame, distinct: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """``tid``, ``packed`` bytes and the anchors in question of every distinct text that may have a repeat."""
    rows = distinct.select("tid", F.explode("anchors").alias("a")).select("tid", "a.place", "a.core")
    # as a table of its own, so that the join below can split a core that very many anchors share
    twice = write_through(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "suffix-cores")
    lists = rows.join(twice, "core").groupBy("tid").agg(F.sort_array(F.collect_list("place")).alias("places"))
    wanted = distinct.select("tid", "sha", "key").join(lists, "tid")
    # repeated rows meet here; each task has sent one of them
    once = packed(docs, key, text, length).groupBy("key", "sha").agg(F.first("packed").alias("packed"))
    return wanted.join(once, (wanted["sha"] == once["sha"]) & wanted["key"].eqNullSafe(once["key"])).select("tid", "packed", "places")


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """``tid``, ``pos`` of the anchor, ``rel`` (bytes ahead of it) and the bytes that its stretches span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", 1 << 18):
            tids, poss, rels, datas = [], [], [], []
            for tid, body, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = unpack(body)
                for place in places:
                    at, first, last = decode_place(place, length // 2)
                    tids.append(tid)
                    poss.append(at)
                    rels.append(at - first)
                    datas.append(text[first : last + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(tids, pa.int64()), pa.array(poss, pa.int32()), pa.array(rels, pa.int32()), pa.array(datas, pa.binary())],
                ["tid", "pos", "rel", "data"],
            )

    return texts.select("tid", "packed", "places").mapInArrow(run, "tid long, pos int, rel int, data binary")


def repeated_spans(texts: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(``tid``, ``start``, ``end``) stretches of the candidate texts that also start elsewhere; they may overlap."""
    spark = texts.sparkSession
    # an anchor stands for about half of ``length // 2`` starts
    total = (length + length // 4) * (texts.agg(F.sum(F.size("places"))).first()[0] or 0)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    suffix = F.expr("substring(data, rel + 1, length(data) - rel)")
    buckets = contexts(texts, length).repartitionByRange(n, suffix, F.xxhash64("tid", "pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got)
        tid, pos, rel, data = (c.to_pylist() for c in table.columns)
        low, high, edges = solve_bucket(data, np.array(rel, dtype=np.int64), length)
        hit = np.flatnonzero(low <= high).tolist()
        out = [(tid[i], pos[i] + int(low[i]), pos[i] + int(high[i]) + length, None, True) for i in hit]
        for i, back, twin in edges:
            at = rel[i] + back
            name = hashlib.blake2b(data[i][at : at + length], digest_size=16).digest()
            out.append((tid[i], pos[i] + back, pos[i] + back + length, name, twin))
        for at in range(0, len(out), 50_000):
            columns = list(zip(*out[at : at + 50_000], strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["tid", "start", "end", "name", "twin"])

    solved = write_through(buckets.mapInArrow(run, LINK + ", name binary, twin boolean"), "suffix-spans")
    inside = solved.filter(F.col("name").isNull()).select("tid", "start", "end")
    # a bucket tells each of its stretches once, so a name has a row for each bucket at most
    told = solved.filter(F.col("name").isNotNull()).groupBy("name")
    across = told.agg(F.count(F.lit(1)).alias("n"), F.collect_list(F.struct("tid", "start", "end")).alias("all"))
    return inside.unionByName(across.filter("n > 1").select(F.explode("all").alias("s")).select("s.*"))


def cut_texts(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``tid``, ``n_removed``, ``n_spans`` (maximal runs) and ``kept`` bytes of the texts that have spans."""
    per_text = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", 1 << 20):
            rows = []
            for tid, body, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = unpack(body)
                kept, at, removed, n = [], 0, 0, 0
                for start, end in sorted((s["start"], s["end"]) for s in found):
                    if start > at or not n:
                        kept.append(text[at:start])
                        n += 1
                        removed += end - start
                    elif end > at:
                        removed += end - at
                    at = max(at, end)
                kept.append(text[at:])
                rows.append((tid, removed, n, b"".join(kept)))
            tids, removed, n, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tids, pa.int64()), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.binary())],
                ["tid", "n_removed", "n_spans", "kept"],
            )

    joined = texts.select("tid", "packed").join(per_text, "tid").select("tid", "packed", "spans")
    return joined.mapInArrow(run, "tid long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` of every document.

    ``kept`` holds the bytes that remain where something was removed, and is null where the text stays
    as it is. A text that another row repeats in full is all removed, in both; texts below ``length``
    bytes never are. Null texts are empty, null keys and repeated rows are kept, extra columns left out.
    """
    if not 4 * GRAM <= length < 1 << 16:
        raise ValueError(f"length must be {4 * GRAM} or more, and below 65536")
    places = write_through(marked(docs, key, text, length), "suffix-anchors")
    distinct = write_through(distinct_texts(places, length), "suffix-distinct")
    texts = write_through(candidates(docs, distinct, key, text, length), "suffix-texts")
    cuts = cut_texts(texts, repeated_spans(texts, length)).withColumn("kept_sha", F.sha2("kept", 256))
    copies = places.filter(F.col("n_bytes") >= length).groupBy("sha").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    # a text is cut in part or is a copy; both sides have a text once
    named = cuts.join(distinct.select("tid", F.col("sha").alias("cut_sha")), "tid")
    changed = copies.join(named, F.col("sha") == F.col("cut_sha"), "full_outer").select(
        F.coalesce("sha", "cut_sha").alias("__sha"), "copies", "n_removed", "n_spans", "kept", "kept_sha"
    )
    rows = places.select(F.col("key").alias(key), "sha", "n_bytes").join(changed, F.col("sha") == F.col("__sha"), "left")
    whole = F.col("copies").isNotNull()
    return rows.select(
        key,
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY.hex())).otherwise(F.coalesce("kept_sha", F.lower(F.hex("sha")))).alias("kept_sha256"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
