"""Reachability and components as rounds of joins.

Every round is written to the shared folder, so lineage stays one round deep and a lost
executor costs one round at most. Rounds double the covered distance: a chain of 150 takes
eight rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.session import discard, scratch_path, write_table, write_through


def transitive_closure(edges: DataFrame, child: str, parent: str, with_path: bool = True) -> DataFrame:
    """All ``(node, ancestor)`` pairs with the shortest ``depth`` and the smallest such ``path``.

    Pairs with ``node = ancestor`` mark cycles. Pairs found at exactly the distance reached so
    far are extended by everything known, so each pair is produced at its shortest distance and
    never revised; nodes already reached are dropped by an anti join.
    """
    spark = edges.sparkSession
    links = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor"))
    links = links.filter(F.col("node").isNotNull() & F.col("ancestor").isNotNull()).distinct()
    known = links.withColumn("depth", F.lit(1))
    if with_path:
        known = known.withColumn("path", F.array("node", "ancestor"))
    columns = known.columns
    schema = known.schema
    rounds = [scratch_path(spark, "closure")]
    known.write.parquet(rounds[0])
    reach = 1
    while True:
        known = spark.read.schema(schema).parquet(*rounds)
        # pairs at exactly this distance were all found in the last round
        frontier = spark.read.schema(schema).parquet(rounds[-1]).filter(F.col("depth") == reach)
        if frontier.isEmpty():
            return known
        onward = known.select(
            F.col("node").alias("__via"),
            F.col("ancestor").alias("__to"),
            F.col("depth").alias("__more"),
            *([F.col("path").alias("__rest")] if with_path else []),
        )
        step = frontier.join(onward, frontier["ancestor"] == onward["__via"]).select(
            "node",
            F.col("__to").alias("ancestor"),
            (F.col("depth") + F.col("__more")).alias("depth"),
            *(
                [F.concat("path", F.slice("__rest", F.lit(2), F.size("__rest"))).alias("path")]
                if with_path
                else []
            ),
        )
        found = step.join(known.select("node", "ancestor"), ["node", "ancestor"], "left_anti")
        best = F.min(F.struct(*columns[2:])).alias("__best")
        found = found.groupBy("node", "ancestor").agg(best).select("node", "ancestor", "__best.*")
        path = scratch_path(spark, "closure")
        found.write.parquet(path)
        rounds.append(path)
        reach *= 2


def reach_from(starts: DataFrame, edges: DataFrame, child: str, parent: str) -> DataFrame:
    """All ``(start, ancestor)`` pairs of the given ``start`` values only, each start its own ancestor.

    Each round follows the edges of the nodes reached last, so the rest of a large graph is never closed;
    there is a round for each level above the starts. NULL starts and edges with a NULL end lead nowhere;
    cycles end.
    """
    spark = starts.sparkSession
    links = edges.select(F.col(child).alias("__child"), F.col(parent).alias("__parent")).filter(F.col("__parent").isNotNull())
    frontier = starts.select("start").filter(F.col("start").isNotNull()).distinct()
    frontier = frontier.withColumn("ancestor", F.col("start"))
    schema, rounds = frontier.schema, []
    while True:
        path = scratch_path(spark, "reach")
        frontier = write_table(frontier, path)
        rounds.append(path)
        known = spark.read.schema(schema).parquet(*rounds)
        if frontier.isEmpty():
            return known
        step = frontier.join(links, F.col("ancestor") == F.col("__child")).select("start", F.col("__parent").alias("ancestor")).distinct()
        frontier = step.join(known, ["start", "ancestor"], "left_anti")


def components(links: DataFrame, item: str, key: str) -> DataFrame:
    """Smallest item id of the connected component of each item, for a long ``(item, key)`` table.

    Items that share a key are linked through the key, never pair by pair, so a key shared by
    very many items costs one row per item. Each round lowers labels through the keys and then
    jumps every label to its own label, which halves chains.
    """
    pairs = write_through(
        links.select(F.col(item).alias("item"), F.col(key).alias("key")).filter(F.col("key").isNotNull()).distinct(),
        "links",
    )
    spark = pairs.sparkSession
    path = scratch_path(spark, "labels")
    labels = write_table(pairs.groupBy("item").agg(F.min("item").alias("label")), path)
    while True:
        by_key = pairs.join(labels, "item").groupBy("key").agg(F.min("label").alias("label"))
        lowered = pairs.join(by_key, "key").groupBy("item").agg(F.min("label").alias("low"))
        hop = labels.select(F.col("item").alias("low"), F.col("label").alias("hop"))
        moved = (
            labels.join(lowered, "item")
            .join(hop, "low", "left")
            .select("item", "label", F.least("label", "low", "hop").alias("next"))
        )
        replaced, path = path, scratch_path(spark, "labels")
        moved = write_table(moved, path)
        discard(spark, replaced)
        labels = moved.select("item", F.col("next").alias("label"))
        if moved.filter(F.col("next") < F.col("label")).isEmpty():
            return labels
