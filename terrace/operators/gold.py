"""Serving tables: star joins, grouped aggregates, incremental refresh."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform_star(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]], unknown: str = "UNKNOWN") -> DataFrame:
    """Left-join dimensions ``name: (dim, fact_key, dim_key)``; misses get ``unknown`` in string columns.

    No broadcast is forced: Spark broadcasts a dimension when its size allows and AQE splits hot
    keys otherwise. Fact key columns stay, dimension key columns go.
    """
    out = fact
    for dim, fact_key, dim_key in dims.values():
        right = dim.withColumnRenamed(dim_key, "__dk")
        attributes = [c for c in right.columns if c != "__dk"]
        text = {n for n, t in right.dtypes if t == "string"}
        joined = out.join(right, F.col(fact_key) == F.col("__dk"), "left")
        out = joined.select(
            *out.columns,
            *[F.coalesce(F.col(c), F.lit(unknown)).alias(c) if c in text else F.col(c) for c in attributes],
        )
    return out


def gold_aggregate(
    df: DataFrame,
    dims: list[str],
    measures: dict[str, Column],
    grouping: str = "plain",
    sets: list[list[str]] | None = None,
) -> DataFrame:
    """Aggregate by ``plain`` groups, ``rollup``, ``cube`` or explicit ``sets``.

    The last three add ``grouping_id`` (bit set = dimension rolled up) and show rolled-up
    dimensions as NULL.
    """
    aggs = [c.alias(n) for n, c in measures.items()]
    if grouping == "plain":
        return df.groupBy(*dims).agg(*aggs)
    level = F.grouping_id().cast("bigint").alias("grouping_id")
    if grouping == "rollup":
        return df.rollup(*dims).agg(level, *aggs)
    if grouping == "cube":
        return df.cube(*dims).agg(level, *aggs)
    if grouping == "sets":
        wanted = [[F.col(d) for d in s] for s in sets or []]
        return df.groupingSets(wanted, *[F.col(d) for d in dims]).agg(level, *aggs)
    raise ValueError(f"unknown grouping {grouping!r}")


def all_sets(dims: list[str]) -> list[list[str]]:
    """Every subset of ``dims``, for ``sets``."""
    return [list(s) for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


PARTS = ("n_rows", "total", "low", "high", "reach")


def partial_aggregate(df: DataFrame, keys: list[str], measure: Column, member: Column) -> DataFrame:
    """Mergeable partials per key: count, sum, min, max and a distinct-count sketch of ``member``."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(measure).alias("total"),
        F.min(measure).alias("low"),
        F.max(measure).alias("high"),
        F.hll_sketch_agg(member).alias("reach"),
    )


def refresh_aggregate(partials: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Merge stored partials with those of new rows without rescanning old rows.

    Valid for inserts only; after deletes recompute the keys concerned.
    """
    return partials.unionByName(delta).groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("reach").alias("reach"),
    )


def serve_partials(partials: DataFrame) -> DataFrame:
    return partials.withColumn("reach", F.hll_sketch_estimate("reach"))
