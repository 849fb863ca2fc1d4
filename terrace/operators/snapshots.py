"""Differences between full snapshots, and feeds of row changes made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.plans.joins import all_of


def _paired(old: DataFrame, new: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """One row per key with structs ``o`` and ``n`` and the kind of change; unchanged keys are dropped."""
    left = old.select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.struct(*keys, *cols).alias("o"))
    right = new.select(*[F.col(k).alias(f"__n_{k}") for k in keys], F.struct(*keys, *cols).alias("n"))
    on = all_of([F.col(f"__o_{k}").eqNullSafe(F.col(f"__n_{k}")) for k in keys])
    same = all_of([F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in cols])
    change = (
        F.when(F.col("o").isNull(), "insert")
        .when(F.col("n").isNull(), "delete")
        .when(~same, "update")
    )
    both = left.join(right, on, "full_outer").withColumn("change", change)
    return both.filter(F.col("change").isNotNull()).select("change", "o", "n")


def diff_snapshots(old: DataFrame, new: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``change`` (insert, update, delete), the keys, and ``old_<col>`` / ``new_<col>`` values."""
    pairs = _paired(old, new, keys, cols)
    return pairs.select(
        "change",
        *[F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys],
        *[F.col(f"o.{c}").alias(f"old_{c}") for c in cols],
        *[F.col(f"n.{c}").alias(f"new_{c}") for c in cols],
    )


def change_feed(old: DataFrame, new: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Row images with ``_change_type`` and ``_version``; an update gives its pre- and post-image."""
    cols = [c for c in new.columns if c not in keys]
    pairs = _paired(old, new, keys, cols)

    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("row"))

    images = (
        F.when(F.col("change") == "insert", F.array(image("insert", "n")))
        .when(F.col("change") == "delete", F.array(image("delete", "o")))
        .otherwise(F.array(image("update_preimage", "o"), image("update_postimage", "n")))
    )
    return pairs.select(F.explode(images).alias("c")).select(
        "c.row.*", "c._change_type", F.lit(version).cast("bigint").alias("_version")
    )


def replay_feed(base: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """State after applying a feed: per key the newest image wins, deletes remove."""
    cols = base.columns
    base_rows = base.select(*cols, F.lit(None).cast("bigint").alias("_version"), F.lit(False).alias("_gone"))
    changes = feed.filter(F.col("_change_type") != "update_preimage").select(
        *cols, "_version", (F.col("_change_type") == "delete").alias("_gone")
    )
    # inside one version a key can be deleted or written, not both; a write outranks a delete
    newest = F.struct(F.coalesce("_version", F.lit(-1)).alias("v"), (~F.col("_gone")).alias("w"))
    rows = base_rows.unionByName(changes)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols, "_gone"), newest).alias("r"))
    return last.filter(~F.col("r._gone")).select(*[F.col(f"r.{c}").alias(c) for c in cols])
