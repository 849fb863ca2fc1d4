"""Mixing sources to target weights with a splitting tree over blocks.

Each source's documents are hashed to blocks, the blocks put in a random order, and the source's
quota of words turned into whole passes plus the first blocks of the next pass; the last block is cut
at a document. A binary tree then splits the exact quotas of block draws among output shards: each
node draws its left half from its quotas by a multivariate hypergeometric distribution. A shard takes
the next draws of each source's order, so no two shards share one, and shuffles its rows locally.

The driver and the tree see one row a source, never documents or blocks. What a document is counted
with is read off the draws as they were dealt.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.session import write_through

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, and how often a source may be passed over.
SHARE, MAX_PASSES = 1.5, 2.0
#: Blocks of a source; the block at the cut is the most that one task ranks.
BLOCKS = 256
SHARDS = 16
#: Parts that a shard may be written in; each is shuffled as a whole.
SHARD_PARTS = 1024
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str) -> Column:
    """The source as a key that is never null: null is the empty text, all else has a mark ahead."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


@dataclass
class SourcePlan:
    source: str
    size: int
    target: float
    passes: int
    rest: float


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MAX_PASSES) -> list[float]:
    """Targets that share ``share`` of all sizes by weight; one that would pass ``most`` times its size stops
    there, and the excess is shared again by weight until none is above."""
    out = [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def plan_sources(sized: DataFrame, weights: tuple[int, ...], share: float, most: float) -> list[SourcePlan]:
    """One entry a source, by code point of the name, null last."""
    found = sized.groupBy("source_key").agg(F.sum("size").alias("size")).collect()
    # the mark ahead of a name puts the null key first; names compare by code point
    rows = sorted(found, key=lambda r: (r["source_key"] == "", r["source_key"]))
    sizes = [int(r["size"]) for r in rows]
    goal = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))], share, most)
    plans = []
    for row, size, target in zip(rows, sizes, goal, strict=True):
        passes = int(target // size) if size else 0
        rest = target - passes * size
        plans.append(SourcePlan(row["source_key"], size, target, passes, 0.0 if passes >= most else rest))
    return plans


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Draws of each source (row) for each shard (column); rows sum to the quotas, columns are alike in size."""
    rng = np.random.default_rng(seed)
    out = np.zeros((len(quotas), shards), dtype=np.int64)

    def node(first: int, last: int, own: np.ndarray) -> None:
        if last - first == 1:
            out[:, first] = own
            return
        middle = (first + last) // 2
        total = int(own.sum())
        wanted = total * (middle - first) // (last - first)
        left = rng.multivariate_hypergeometric(own, wanted, method="marginals") if total else own
        node(first, middle, left)
        node(middle, last, own - left)

    if len(quotas):
        node(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def sized_rows(docs: DataFrame, key: str, source: str, text: str, seed: int, blocks: int) -> DataFrame:
    """``docs`` with ``size``, ``source_key``, the place ``rank`` in a random order and ``block``."""
    rank = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    return docs.select(
        "*", word_count(text).alias("__size"), source_key(source).alias("__source"), rank.alias("__rank"),
        F.pmod(F.xxhash64(F.lit(seed + 1), rank), F.lit(blocks)).cast("int").alias("__block"),
    )


def decide(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
           share: float = SHARE, most: float = MAX_PASSES, seed: int = SEED, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame, list[SourcePlan]]:
    """Sizes of all documents, each row under a number ``row`` of its own; a row a block with what the mix takes of it; the sources' plans.

    A block is taken ``passes`` times in full, and once more those of its documents whose rank is at
    most ``cut`` (null: none). The document at the cut is taken where that brings the source nearer to
    its target. Rows alike in key and text have one rank and go together.
    """
    spark = docs.sparkSession
    marked = sized_rows(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).cast("string").alias("text")), "key", "source", "text", seed, blocks)
    sized = write_through(
        marked.select("key", F.col("__size").alias("size"), F.col("__source").alias("source_key"), F.col("__rank").alias("rank"), F.col("__block").alias("block"), F.monotonically_increasing_id().alias("row")),
        "mix-sizes",
    )
    plans = plan_sources(sized, weights, share, most)
    table = spark.createDataFrame(
        [(p.source, p.size, p.target, p.passes, p.rest) for p in plans], "source_key string, source_size long, target double, passes int, rest double"
    )
    whole = sized.groupBy("source_key", "block").agg(F.sum("size").alias("words"))
    place = Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(seed + 2), "source_key", "block"), "block")
    ordered = whole.withColumn("at", F.row_number().over(place) - 1)
    ordered = ordered.withColumn("ahead", F.coalesce(F.sum("words").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # the blocks of a source are few; what is left of its quota when a block's turn comes
    quota = write_through(ordered.join(table, "source_key").withColumn("left", F.col("rest") - F.col("ahead")), "mix-blocks")
    split = quota.filter((F.col("left") > 0) & (F.col("left") < F.col("words"))).select("source_key", "block", "left")
    by_rank = sized.filter("size > 0").join(split, ["source_key", "block"]).groupBy("source_key", "block", "rank", "left").agg(F.sum("size").alias("size"))
    within = Window.partitionBy("source_key", "block").orderBy("rank")
    before = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = by_rank.withColumn("before", before).filter(F.col("before") + F.col("size") / 2 <= F.col("left"))
    cuts = cuts.groupBy("source_key", "block").agg(F.max("rank").alias("cut_at"))
    full = F.col("left") >= F.col("words")
    taken = quota.join(cuts, ["source_key", "block"], "left").withColumn("cut", F.when(full, F.lit((1 << 63) - 1)).otherwise(F.col("cut_at")))
    return sized, taken.select("source_key", "block", "at", "words", "source_size", "target", "passes", "cut"), plans


def deal(rows: DataFrame, taken: DataFrame, shards: int, seed: int) -> DataFrame:
    """``rows`` (with the columns of ``sized_rows``) once for each time the mix draws them, dealt to shards and shuffled in them.

    ``taken`` is the table of blocks that ``decide`` gives. The tree splits each source's draws of blocks among the shards.
    """
    spark = rows.sparkSession
    taken = write_through(taken, "mix-taken")
    draws_of = F.col("passes") + F.when(F.col("cut").isNotNull(), 1).otherwise(0)
    own = taken.groupBy("source_key").agg(F.sum(draws_of).alias("draws"), F.count(F.lit(1)).alias("n_blocks")).orderBy("source_key").collect()
    tree = split_quotas(np.array([r["draws"] for r in own], dtype=np.int64), shards, seed)
    bounds = np.cumsum(tree, axis=1).tolist() if len(own) else []
    table = spark.createDataFrame(
        [(r["source_key"], int(r["n_blocks"]), b) for r, b in zip(own, bounds, strict=True)], "source_key string, n_blocks long, bounds array<long>"
    )
    plan = taken.join(table, "source_key").drop("words", "source_size", "target").withColumnRenamed("source_key", "__source").withColumnRenamed("block", "__block")
    names = [F.col(f"`{c}`") for c in rows.columns]
    # shards are split further, so that one is as many tasks as the session's shuffles have
    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    picked = rows.join(plan, ["__source", "__block"])
    times = F.col("passes") + F.when(F.col("__rank") <= F.col("cut"), 1).otherwise(0)
    drawn = picked.withColumn("__times", times).filter("__times > 0").withColumn("__pass", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))
    # the draws of a source are numbered by pass, then by place; the cut block comes last of all
    number = F.col("__pass") * F.col("n_blocks") + F.col("at")
    shard = F.size(F.filter("bounds", lambda b: b <= number))
    order = F.xxhash64(F.lit(seed + 3), "__rank", "__pass")
    return drawn.select(*names, shard.alias("__shard"), order.alias("__order")).repartition(parts, "__shard", F.pmod("__order", F.lit(SHARD_PARTS))).sortWithinPartitions("__shard", "__order")


def quotas_taken(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, **settings) -> DataFrame:
    """``key``, ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``copies`` of every document.

    ``copies`` counts the draws of a row that were dealt to shards. Null sources come last and are a source;
    a null text has size 0. Documents without words are never taken more than the blocks they are in.
    Repeated rows and null keys are counted each for itself. An empty table gives no rows.
    """
    sized, taken, plans = decide(docs, seed=seed, **settings)
    goals = docs.sparkSession.createDataFrame([(p.source, p.size, p.target) for p in plans], "source_key string, source_size long, target double")
    marked = sized.select("row", F.col("source_key").alias("__source"), F.col("rank").alias("__rank"), F.col("block").alias("__block"))
    dealt = write_through(deal(marked, taken, shards, seed).select("row", "__shard"), "mix-dealt")
    counted = dealt.groupBy("row").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    joined = sized.join(counted, "row", "left").join(goals, "source_key").withColumn("copies", F.coalesce("copies", F.lit(0)))
    return joined.select("key", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", shards: int = SHARDS, seed: int = SEED, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns, dealt to shards and shuffled in them.

    Null sources come last and are a source; a null text has size 0. Rows alike in key and text, null keys
    too, have one place in the order and go together. Ties of the order stand for such rows only. Columns
    may have any names; an empty table gives no rows.
    """
    _, taken, _ = decide(docs, key, source, text, seed=seed, **settings)
    nested = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), F.col(key).alias("__key"), F.col(source).alias("__name"), F.col(text).cast("string").alias("__text")
    )
    rows = sized_rows(nested, "__key", "__name", "__text", seed, settings.get("blocks", BLOCKS)).drop("__key", "__name", "__text")
    return deal(rows, taken, shards, seed).select("__doc.*")
