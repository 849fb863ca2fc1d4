"""Near copies by SimHash and min-hashes of five-word shingles, each link checked on the shingles themselves.

The links of SimHash fingerprints (:mod:`terrace.llm.simhash`) give lists of texts, one a component. Texts
that share 0.8 of their shingles are about ten of 64 bits apart as fingerprints, though, which no set of
byte positions can list. So a text is also listed under each band of its min-hash signature, and only
texts that share a list of either kind are moved, once. In a list every text is compared with
those of the smallest keys; these and the texts alike to one of them leave the list, and the rest goes into
another round with four times as many. So a list of n copies gives a few times n comparisons, the rounds
grow with the logarithm of the longest list, and of two texts that are alike and meet in a list never both stay.
Texts are compared in blocks within tasks. A list of n texts that are not alike takes n * n / 2 comparisons,
but moves and rows stay near n for each block of hubs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from terrace.llm.arrays import slices
from terrace.llm.simhash import fingerprint, labelled
from terrace.plans.closure import components
from terrace.session import discard, scratch_path, write_table

SEED, SHINGLE_WORDS, MIN_SIMILARITY = 42, 5, 0.8
#: Bands of a signature and min-hashes of each: 1 - (1 - 0.8 ** 5) ** 16 = 0.998 of the pairs at 0.8 meet.
BANDS, ROWS = 16, 5
#: Texts of a list that all others are compared with in the first round, and how many times more in each further one.
HUBS, MORE_HUBS = 4, 4
#: Texts of a list that one copy of such texts serves, and such texts that a task holds at once.
PART_ROWS, HUB_BLOCK = 64, 32
#: Shingles hashed anew at once.
BLOCK = 4096
_draw = np.random.default_rng(SEED)
STEPS = _draw.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
SHIFTS = _draw.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a shorter text is one shingle."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(found))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(found[k : k + size]), SEED) for k in range(len(found) - size + 1)], dtype=np.uint64))


def band_hashes(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit hash for each band of the signature; none without shingles."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(hashes), BLOCK):
        np.minimum(least, (hashes[at : at + BLOCK] * STEPS + SHIFTS).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), k) for k, r in enumerate(rows)], dtype=np.uint64).view(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays without repeats; two empty ones are alike."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether :func:`similarity` reaches ``least``; sets of too different size cannot, and are not compared."""
    return min(len(a), len(b)) >= least * max(len(a), len(b)) and similarity(a, b) >= least


def signed_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``packed`` text, the other columns as ``rest``, ``id`` (a hash of the shingles, so that copies share it), ``bands`` and ``fp``, the SimHash fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            sets = [shingles(t) for t in texts]
            ids = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
            bands = pa.array([band_hashes(s) for s in sets], pa.list_(pa.int64()))
            packed = pa.array([None if t is None else pack(t.encode()) for t in texts], pa.binary())
            fps = np.array([fingerprint((t or "").encode(), SHINGLE_WORDS) for t in texts], dtype=np.uint64).view(np.int64)
            columns = [batch.column("key"), packed, batch.column("rest"), pa.array(ids), bands, pa.array(fps)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "packed", "rest", "id", "bands", "fp"])

    # text, when it is the only column, leaves nothing to carry
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.lit(True).alias("__row"))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), rest.alias("rest"))
    schema = StructType([rows.schema["key"], StructField("packed", BinaryType()), rows.schema["rest"], StructField("id", LongType()), StructField("bands", ArrayType(LongType())), StructField("fp", LongType())])
    return rows.mapInArrow(run, schema)


def unpacked(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from ``packed`` and ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "packed", 1 << 19):
            texts = [None if p is None else unpack(p).decode() for p in batch.column("packed").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("rest")], ["text", "rest"])

    open_ = rows.select("packed", "rest").mapInArrow(run, StructType([StructField("text", StringType()), rows.schema["rest"]]))
    return open_.select(*[F.col("text").cast(docs.schema[text].dataType).alias(text) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def verified(entries: DataFrame, hubs: DataFrame, texts: DataFrame, most: int, least: float) -> DataFrame:
    """(``bucket``, ``id``, ``hub``) of texts and hubs of their lists that share at least ``least`` of their shingles.

    ``entries`` has ``bucket``, ``id`` and the length ``n`` of the list, ``hubs`` these and the ``place`` up to ``most``.
    A list is cut into parts and its hubs into blocks; each part meets each block in one task, so a text
    is moved once for a block and no row stands for a pair. Tasks hold the shingles of one block and one text.
    """
    parts = F.ceil(F.col("n") / PART_ROWS).cast("int")
    blocks = F.ceil(F.least("n", F.lit(most)) / HUB_BLOCK).cast("int")
    placed = entries.join(hubs.select("bucket", "id", "place"), ["bucket", "id"], "left")
    members = placed.select(
        "bucket", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.lit(False).alias("is_hub"), "place", "id",
    )
    sent = hubs.select(
        "bucket", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.floor((F.col("place") - 1) / HUB_BLOCK).cast("int").alias("block"),
        F.lit(True).alias("is_hub"), "place", "id",
    )
    at = ["bucket", "part", "block"]
    rows = members.unionByName(sent).join(texts, "id").repartition(*at).sortWithinPartitions(*at, F.desc("is_hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        last, block = None, []
        for batch in slices(batches, "packed", 1 << 19):
            found = []
            groups = zip(*[batch.column(c).to_pylist() for c in at], strict=True)
            for k, (group, is_hub, place, one) in enumerate(zip(groups, *[batch.column(c).to_pylist() for c in ("is_hub", "place", "id")], strict=True)):
                if group != last:
                    last, block = group, []
                own = shingles(unpack(batch.column("packed")[k].as_py()).decode())
                if is_hub:
                    block.append((place, one, own))
                    continue
                # of two hubs the later one is compared with the earlier
                found += [(group[0], one, hub) for p, hub, known in block if (place is None or p < place) and alike(own, known, least)]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in range(3)], ["bucket", "id", "hub"])

    return rows.select(*at, "is_hub", "place", "id", "packed").mapInArrow(run, "bucket long, id long, hub long")


def links(entries: DataFrame, texts: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """Links (``id``, ``hub``) at ``least`` or more; ``entries`` has ``id``, ``first`` (its smallest key) and ``bucket``, a list of two or more."""
    spark = entries.sparkSession
    found, most, replaced = scratch_path(spark, "near-links"), HUBS, []
    spark.createDataFrame([], "id long, hub long").write.parquet(found)
    while True:
        paths = [scratch_path(spark, f"near-{name}") for name in ("long", "hubs", "alike", "lists")]
        sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        entries = write_table(entries.join(sizes, "bucket"), paths[0])
        if entries.isEmpty():
            for path in [*replaced, paths[0]]:
                discard(spark, path)
            return spark.read.schema("id long, hub long").parquet(found)
        # Spark keeps so many of a list in each task before they meet
        place = F.row_number().over(Window.partitionBy("bucket").orderBy("first", "id"))
        hubs = write_table(entries.withColumn("place", place).filter(F.col("place") <= most).select("bucket", "id", "n", "place"), paths[1])
        met = write_table(verified(entries, hubs, texts, most, least), paths[2])
        met.select("id", "hub").distinct().write.mode("append").parquet(found)
        gone = hubs.select("bucket", "id").unionByName(met.select("bucket", "id")).distinct()
        entries = write_table(entries.drop("n").join(gone, ["bucket", "id"], "left_anti"), paths[3])
        for path in [*replaced, *paths[:3]]:
            discard(spark, path)
        replaced, most = paths[3:], most * MORE_HUBS


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = MIN_SIMILARITY) -> DataFrame:
    """One row of each group linked by near copies: of the smallest key, and of its rows any one of the same shingles.

    Groups are of texts: two unlike texts under one key stay both, a text repeated under it stays once.
    Documents without words, null and empty ones, are copies of each other. Documents with a null key are
    told apart from no other and stay. Further columns stay as they are, whatever their names.
    """
    spark = docs.sparkSession
    paths = {name: scratch_path(spark, f"near-{name}") for name in ("rows", "distinct", "prints", "lists", "texts")}
    rows = write_table(signed_rows(docs, key, text).withColumn("row", F.monotonically_increasing_id()), paths["rows"])
    keyed = rows.filter(F.col("key").isNotNull())
    first = keyed.groupBy("id").agg(F.min(F.struct("key", "row")).alias("one")).select("id", F.col("one.key").alias("first"), "one.row")
    distinct = write_table(first, paths["distinct"])
    banded = keyed.join(distinct.select("row", "first"), "row").select("id", "first", F.explode("bands").alias("bucket"))
    # equal shingles may repeat otherwise in two texts, so a text of one id may have several fingerprints
    prints = write_table(keyed.filter(F.size("bands") > 0).select("id", "fp").distinct(), paths["prints"])
    marked = prints.join(labelled(prints.select("fp").distinct()), "fp").select("id", F.xxhash64(F.lit("simhash"), "label").alias("bucket")).distinct()
    listed = banded.unionByName(marked.join(distinct, "id").select("id", "first", "bucket"))
    # bands that list the same texts are one list: their number and two sums of hashes tell them
    hashed = F.xxhash64("id").cast("decimal(38,0)")
    sets = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("s"), F.bit_xor("id").alias("x")).filter("n > 1")
    several = sets.groupBy("n", "s", "x").agg(F.min("bucket").alias("bucket")).select("bucket")
    entries = write_table(listed.join(several, "bucket"), paths["lists"])
    candidates = entries.select("id").distinct().join(distinct, "id").select("row")
    texts = write_table(rows.select("row", "id", "packed").join(candidates, "row").select("id", "packed"), paths["texts"])
    linked = links(entries, texts, least)
    pairs = linked.select("id", F.col("hub").alias("root")).unionByName(linked.select(F.col("hub").alias("id"), F.col("hub").alias("root")))
    labels = components(pairs, "id", "root").select(F.col("item").alias("id"), "label")
    group = distinct.join(labels, "id", "left").groupBy(F.coalesce("label", "id").alias("label"))
    chosen = group.agg(F.min(F.struct("first", "row")).alias("one")).select("one.row")
    for name in ("prints", "lists", "texts"):
        discard(spark, paths[name])
    stay = rows.select("row", "packed", "rest").join(chosen, "row", "left_semi").drop("row")
    return unpacked(stay.unionByName(rows.filter(F.col("key").isNull()).select("packed", "rest")), docs, text)
