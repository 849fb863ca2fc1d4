"""Benchmark items inside documents, also with other numbers, names or units.

Words become templates: numbers with their units, and capitalised names, turn into typed placeholders,
a run of one kind into one; all else is lower-cased without outer punctuation. A second stream of
templates takes names for plain words, so that it does not depend on case. Windows of template words
are hash-joined with those of the benchmark. The windows that a document and an item share are chained
in order over neighbouring diagonals, so words put in or left out do not break a match. Where the
matched plain words alone are not enough, the values in the slots are compared: an item's value must
stand for one value of the document and the other way round, so a re-parameterised question is caught
and a chance run of placeholders is not.

A bit set of the benchmark's windows, of one size whatever the benchmark's, keeps windows that no item
has from being moved; the join and the slots decide.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.arrays import slices, words
from terrace.session import scratch_path, write_table

#: Template words of a window; an item below it is one window, below LEAST_WORDS words it is too short to tell.
WINDOW, LEAST_WORDS = 8, 5
#: A document holds an item if the matched windows span this share of its template words, or so many in a
#: row of which so many are plain. Values in slots count for nothing once plain words alone come to either.
SHARE, RUN, RUN_PLAIN = 0.6, 13, 8
#: Neighbouring diagonals this far apart go on in one chain.
DRIFT = 8
#: Bits of the set, and how many of them a window has.
BITS, PROBES = 1 << 24, 4
OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’¿¡…–—"
NUMBER = r"^[+-]?[$€£]?[0-9][0-9.,:/]*\p{L}{0,3}%?$"
NAME = r"^\p{Lu}\p{Ll}"
# fixed list of units
UNITS = [
    "%", "mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "mile", "miles", "mg", "g", "kg", "lb", "lbs", "ton", "tons",
    "ml", "l", "liter", "liters", "litre", "litres", "s", "sec", "second", "seconds", "min", "minute", "minutes", "hour", "hours",
    "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents",
    "kmh", "mph", "watt", "watts", "volt", "volts", "degree", "degrees", "meter", "meters", "metre", "metres", "gram", "grams",
]
#: Kinds of template words; names are such in the first stream alone.
PLAIN, VALUE, NAMED = 0, 1, 2
STREAMS = (True, False)
STEP = np.uint64(0x9E3779B97F4A7C15)


def word_kinds(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Kind of every word, and a 64-bit hash of it in lower case without outer punctuation."""
    if not len(flat):
        return np.zeros(0, dtype=np.int8), np.zeros(0, dtype=np.uint64)
    coded = flat.dictionary_encode()
    distinct = coded.dictionary
    bare = pc.utf8_trim(distinct, characters=OUTER)
    bare = pc.if_else(pc.equal(pc.binary_length(bare), 0), distinct, bare)
    low = pc.utf8_lower(bare)
    value = pc.or_(pc.match_substring_regex(bare, NUMBER), pc.is_in(low, value_set=pa.array(UNITS, distinct.type))).to_numpy(zero_copy_only=False)
    named = pc.match_substring_regex(bare, NAME).to_numpy(zero_copy_only=False)
    kinds = np.where(value, VALUE, np.where(named, NAMED, PLAIN)).astype(np.int8)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, low.to_pylist())), dtype=np.uint64)
    at = coded.indices.to_numpy(zero_copy_only=False)
    return kinds[at], hashes[at]


def template(kinds: np.ndarray, hashes: np.ndarray, owner: np.ndarray, names: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Template words of texts that lie one after the other: hash, value (0 for plain words), number of the text."""
    if not names:
        kinds = np.where(kinds == NAMED, PLAIN, kinds)
    goes_on = (kinds[1:] != PLAIN) & (kinds[1:] == kinds[:-1]) & (owner[1:] == owner[:-1])
    first = np.flatnonzero(np.concatenate((np.ones(min(len(kinds), 1), dtype=bool), ~goes_on)))
    if not len(first):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    kind = kinds[first]
    inside = np.arange(len(kinds)) - np.repeat(first, np.diff(np.append(first, len(kinds))))
    values = np.add.reduceat(hashes * (2 * inside + 1).astype(np.uint64), first) | np.uint64(1)
    slot = kind != PLAIN
    return np.where(slot, kind.astype(np.uint64), hashes[first]), np.where(slot, values, np.uint64(0)), owner[first]


def window_hashes(hashes: np.ndarray, size: int, names: bool) -> np.ndarray:
    """A hash of the ``size`` template words from each one on; streams and sizes have hashes of their own."""
    n = max(len(hashes) - size + 1, 0)
    out = np.full(n, 2 * size + names, dtype=np.uint64)
    for k in range(size):
        out *= STEP
        out ^= out >> np.uint64(31)
        out += hashes[k : k + n]
    out *= STEP
    return out ^ (out >> np.uint64(29))


def probe(hashes: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th bit of each window."""
    turned = (hashes + np.uint64(k)) * STEP
    return (turned ^ (turned >> np.uint64(32))) & np.uint64(BITS - 1)


def listed(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    """One list for each of ``n`` texts; ``owner`` rises."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def item_windows(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``number``, ``item``, ``names`` (stream), ``values`` and ``windows`` of every item that is long enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            flat, counts = words(batch.column("text"))
            kinds, hashes = word_kinds(flat)
            owner = np.repeat(np.arange(len(counts)), counts)
            for names in STREAMS:
                coded, values, of = template(kinds, hashes, owner, names)
                sizes = np.bincount(of, minlength=len(counts))
                fit = np.flatnonzero(counts >= LEAST_WORDS)
                lists, begin = [], np.cumsum(sizes) - sizes
                for k in fit.tolist():
                    own = coded[begin[k] : begin[k] + sizes[k]]
                    lists.append(window_hashes(own, min(WINDOW, len(own)), names).view(np.int64).tolist())
                values_of = listed(values, of, len(counts)).take(pa.array(fit))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(fit)), pa.array(np.full(len(fit), names)), values_of, pa.array(lists, pa.list_(pa.int64()))],
                    ["item", "names", "values", "windows"],
                )

    kind = benchmark.schema[item].dataType.simpleString()
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(run, f"item {kind}, names boolean, values array<long>, windows array<long>")
    return found.withColumn("number", F.monotonically_increasing_id())


def bit_set(items: DataFrame) -> np.ndarray:
    """The bits of all windows of the items: ``BITS`` of them, so the driver gets ``BITS / 64`` numbers at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(batch.column("window")).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([probe(hashes, k) for k in range(PROBES)]).astype(np.int32))], ["bit"])

    bits = items.select(F.explode("windows").alias("window")).mapInArrow(run, "bit int")
    word = F.expr("shiftleft(1L, bit & 63)")
    found = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(word).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, dtype=np.int64)
    out[np.asarray(found.column("word"))] = np.asarray(found.column("bits"))
    return out.view(np.uint64)


def known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the windows all of whose bits are set."""
    at = np.arange(len(hashes))
    for k in range(PROBES):
        bit = probe(hashes[at], k)
        at = at[(bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1]
    return at


def text_windows(docs: DataFrame, shared, sizes: list[tuple[bool, int]]) -> DataFrame:
    """``key``, ``sha``, ``names``, ``values`` and the windows in the bit set (``window``, ``place``) of the texts that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in slices(batches):
            flat, counts = words(batch.column("text"))
            kinds, hashes = word_kinds(flat)
            owner = np.repeat(np.arange(len(counts)), counts)
            for names in STREAMS:
                coded, values, of = template(kinds, hashes, owner, names)
                begin = np.searchsorted(of, np.arange(len(counts)))
                found = []
                for size in [n for stream, n in sizes if stream == names]:
                    windows = window_hashes(coded, size, names)
                    at = known(bits, windows)
                    at = at[of[at] == of[at + size - 1]]
                    found.append((of[at], windows[at], at - begin[of[at]]))
                if not sum(len(x[0]) for x in found):
                    continue
                texts, windows, places = (np.concatenate(x) for x in zip(*found, strict=True))
                by = np.argsort(texts, kind="stable")
                texts, windows, places = texts[by], windows[by], places[by]
                hit, offsets = np.unique(texts), np.searchsorted(texts, np.append(np.unique(texts), len(counts))).astype(np.int32)
                pairs = pa.StructArray.from_arrays([pa.array(windows.view(np.int64)), pa.array(places.astype(np.int32))], ["window", "place"])
                rows = batch.select(["key", "sha"]).take(pa.array(hit))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.full(len(hit), names)), listed(values, of, len(counts)).take(pa.array(hit)), pa.ListArray.from_arrays(pa.array(offsets), pairs)],
                    ["key", "sha", "names", "values", "hits"],
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, sha string, names boolean, values array<long>, hits array<struct<window:long,place:int>>")


def chained(pairs: list[tuple[int, int]], size: int) -> list[list[tuple[int, int, int]]]:
    """Chains of matched stretches (first and last place behind in the item, distance to the text) from shared windows
    (place in the text, place in the item). Stretches of a chain keep their order; the longest are placed first."""
    diagonals: dict[int, list[int]] = defaultdict(list)
    for p, q in pairs:
        diagonals[p - q].append(q)
    chains: list[list[tuple[int, int, int]]] = []
    last = None
    for d in sorted(diagonals):
        if last is None or d - last > DRIFT:
            chains.append([])
        last = d
        stretch: list[int] = []
        for q in sorted(diagonals[d]):
            if stretch and q <= stretch[1]:
                stretch[1] = q + size
            else:
                if stretch:
                    chains[-1].append((stretch[0], stretch[1], d))
                stretch = [q, q + size]
        chains[-1].append((stretch[0], stretch[1], d))
    out = []
    for stretches in chains:
        placed: list[tuple[int, int, int]] = []
        for start, end, d in sorted(stretches, key=lambda x: (x[0] - x[1], x)):
            for a, b, other in placed:
                if start < a:
                    end = min(end, a, a + other - d)
                else:
                    start = max(start, b, b + other - d)
            if start < end:
                placed.append((start, end, d))
        out.append(sorted(placed))
    return out


def held(item: list[int], text: list[int], pairs: list[tuple[int, int]], share: float, run: int) -> tuple[float, int] | None:
    """Share of the item's template words and number of those matched, for the best chain by which the text holds it."""
    best = None
    size = min(WINDOW, len(item))
    for chain in chained(pairs, size):
        places = [(q, q + d) for start, end, d in chain for q in range(start, end)]
        plain = [q for q, _ in places if not item[q]]
        part = len(places) / len(item)
        in_a_row = max((sum(not item[q] for q in range(start, end)) for start, end, _ in joined(chain) if end - start >= run), default=0)
        if part < share and in_a_row < RUN_PLAIN:
            continue
        if len(plain) / len(item) < share and in_a_row < run and not same_slots(item, text, places):
            continue
        if best is None or (part, len(places)) > best:
            best = part, len(places)
    return best


def joined(chain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches of a chain that follow each other without a gap in the item, as one."""
    out: list[tuple[int, int, int]] = []
    for start, end, d in chain:
        if out and out[-1][1] == start:
            out[-1] = (out[-1][0], end, d)
        else:
            out.append((start, end, d))
    return out


def same_slots(item: list[int], text: list[int], places: list[tuple[int, int]]) -> bool:
    """Whether the values in the slots stand for one value each, both ways."""
    there: dict[int, int] = {}
    back: dict[int, int] = {}
    for q, p in places:
        if item[q] and (there.setdefault(item[q], text[p]) != text[p] or back.setdefault(text[p], item[q]) != item[q]):
            return False
    return True


def found_items(docs: DataFrame, benchmark: DataFrame, item: str, item_text: str, share: float, run: int) -> DataFrame:
    """(``key``, ``sha``, ``row``, ``item``, ``share``, ``n_words``) of ``docs`` with ``key``, ``text`` and ``sha``."""
    spark = docs.sparkSession
    items = write_table(item_windows(benchmark, item, item_text), scratch_path(spark, "bench-items"))
    sizes = items.select("names", F.least(F.size("values"), F.lit(WINDOW)).alias("size")).distinct().collect()
    shared = spark.sparkContext.broadcast(bit_set(items))
    texts = text_windows(docs, shared, sorted((r["names"], r["size"]) for r in sizes))
    texts = write_table(texts.withColumn("row", F.monotonically_increasing_id()), scratch_path(spark, "bench-texts"))
    windows = items.select("number", F.posexplode("windows").alias("q", "window"))
    hits = texts.select("row", F.explode("hits").alias("hit")).select("row", F.col("hit.window").alias("window"), F.col("hit.place").alias("p"))
    met = hits.join(windows, "window").groupBy("row", "number").agg(F.collect_list(F.struct("p", "q")).alias("pairs"))
    both = met.join(items.select("number", "item", F.col("values").alias("of_item")), "number").join(texts.select("row", "key", "sha", F.col("values").alias("of_text")), "row")
    kinds = docs.schema["key"].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("of_item", "of_text", "pairs")]
            verdicts = [held(i, t, [(x["p"], x["q"]) for x in pairs], share, run) for i, t, pairs in zip(*columns, strict=True)]
            keep = [k for k, v in enumerate(verdicts) if v]
            rows = batch.select(["key", "sha", "row", "item"]).take(pa.array(keep, pa.int64()))
            shares, counts = pa.array([verdicts[k][0] for k in keep], pa.float64()), pa.array([verdicts[k][1] for k in keep], pa.int64())
            yield pa.RecordBatch.from_arrays([*rows.columns, shares, counts], ["key", "sha", "row", "item", "share", "n_words"])

    return both.select("key", "sha", "row", "item", "of_item", "of_text", "pairs").mapInArrow(
        judge, f"key {kinds[0]}, sha string, row long, item {kinds[1]}, share double, n_words long"
    )


def contained_items(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                    item_text: str = "text", share: float = SHARE, run: int = RUN) -> DataFrame:
    """(``key``, ``item``, ``share``, ``n_words``): every benchmark item that a document holds, whole or in large part.

    ``n_words`` counts template words, ``share`` is their share of the item's. Null and empty texts hold
    nothing, empty tables give no rows, items below ``LEAST_WORDS`` words are not sought. One row for each
    item id and document key: repeated rows and repeated items give their best share once. Null keys and
    null item ids are keys and ids. Further columns are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.lit("").alias("sha"))
    found = found_items(rows, benchmark, item, item_text, share, run)
    best = found.groupBy("key", "item").agg(F.max(F.struct("share", "n_words")).alias("best"))
    return best.select(F.col("key").alias(key), F.col("item").alias(item), "best.share", "best.n_words")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", share: float = SHARE, run: int = RUN) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, their columns as they are, whatever their names.

    Rows of one text share one verdict, so repeated rows stay or go together; null and empty texts stay.
    """
    sha = F.sha2(F.col(f"`{text}`").cast("string"), 256)
    rows = docs.select(F.lit(0).alias("key"), F.col(f"`{text}`").cast("string").alias("text"), sha.alias("sha"))
    spark = docs.sparkSession
    gone = write_table(found_items(rows, benchmark, "item_id", "text", share, run).select("sha").distinct(), scratch_path(spark, "bench-gone"))
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.coalesce(sha, F.lit("")).alias("__sha"))
    return nested.join(gone, nested["__sha"] == gone["sha"], "left_anti").select("doc.*")
