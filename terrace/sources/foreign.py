"""Reads that leave the lake: foreign catalogs, parallel pulls, cross-source joins and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.snapshots import diff_snapshots
from terrace.plans.joins import any_of, null_safe_join
from terrace.sources.tables import path_exists


def register_jdbc_catalog(spark: SparkSession, catalog: str, url: str, driver: str, **options: str) -> None:
    """Make a relational database visible as ``catalog`` with every pushdown switched on."""
    prefix = f"spark.sql.catalog.{catalog}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    settings = {
        "url": url,
        "driver": driver,
        "pushDownAggregate": "true",
        "pushDownLimit": "true",
        "pushDownOffset": "true",
        "pushDownTableSample": "true",
        **options,
    }
    for key, value in settings.items():
        spark.conf.set(f"{prefix}.{key}", value)


def read_foreign(spark: SparkSession, catalog: str, namespace: str, table: str) -> DataFrame:
    """A table of a registered catalog, read in place; filters and aggregates push down to it."""
    return spark.table(".".join(f"`{part}`" for part in (catalog, namespace, table)))


def read_foreign_parallel(
    spark: SparkSession, url: str, table: str, column: str, lower, upper, n: int, properties: dict | None = None
) -> DataFrame:
    """Read a remote table with ``n`` tasks. The bounds only place the cuts; no row is left out."""
    if n < 1:
        raise ValueError("n must be at least 1")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    return reader.options(
        partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(n)
    ).load()


def key_ranges(keys: DataFrame, on: str, ranges: int) -> DataFrame:
    """At most ``ranges`` rows (low, high) that cover every key but NULL, about equally many rows of ``keys`` in each.

    Spark range-partitions the keys, so any type with an order will do; each partition is one range.
    """
    cut = keys.select(F.col(on).alias("__k")).filter(F.col("__k").isNotNull()).repartitionByRange(ranges, "__k")
    return cut.groupBy(F.spark_partition_id().alias("__part")).agg(F.min("__k").alias("low"), F.max("__k").alias("high")).drop("__part")


def join_federated(local: DataFrame, remote: DataFrame, on: str, ranges: int = 64, how: str = "inner") -> DataFrame:
    """Join with a remote table of which only the ranges that the local keys cover are read.

    At most ``ranges`` pairs of bounds reach the driver, however many keys there are; a range of one
    key becomes an equality. They push down to the remote read, the join itself decides about each row.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins may shrink the remote side")
    bounds = key_ranges(local, on, ranges).collect()
    at = F.col(on)
    single = [r["low"] for r in bounds if r["low"] == r["high"]]
    inside = [at.between(r["low"], r["high"]) for r in bounds if r["low"] != r["high"]]
    covered = any_of(([at.isin(single)] if single else []) + inside)
    return local.join(remote.filter(covered), on, how)


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """One table over many sources; columns a source lacks are NULL."""
    tagged = [df.select(F.lit(name).alias("_source"), "*") for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def source_digest(df: DataFrame) -> DataFrame:
    """Row count and an order-free checksum, one row, reduced map-side.

    A hash passes over NULLs, so that it also takes whether each column is NULL.
    """
    names = sorted(df.columns)
    checksum = F.sum(F.xxhash64(*names, *[F.col(c).isNull() for c in names]).cast("decimal(38,0)"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(checksum, F.lit(0)).alias("checksum"))


def reconcile_sources(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` missing from ``b`` (delete), extra in ``b`` (insert) or changed (update).

    The checksums (two single rows) are compared first: equal sources are never joined.
    """
    left, right = source_digest(a).first(), source_digest(b).first()
    cols = [c for c in a.columns if c not in keys]
    if left == right:
        return diff_snapshots(a.limit(0), b.limit(0), keys, cols)
    return diff_snapshots(a, b, keys, cols)


def pull_increment(
    remote: DataFrame, cursor: str, since=None, pulled: DataFrame | None = None, keys: list[str] | None = None
) -> DataFrame:
    """Remote rows at or above the high-water mark, and those without a cursor; the comparison pushes down.

    Rows that tie with the mark may have come after the last pull, and rows without a cursor have no
    place at all, so both come again. With the ``pulled`` rows and their ``keys``, those already held
    with the same cursor are left out; only the part of ``pulled`` at the mark or without a cursor is read.
    """
    if since is None:
        return remote
    at = F.col(cursor)
    fresh = remote.filter((at >= F.lit(since)) | at.isNull())
    if pulled is None:
        return fresh
    if not keys:
        raise ValueError("name the keys by which pulled rows are known")
    held = pulled.filter((at == F.lit(since)) | at.isNull()).select(*keys, cursor)
    return null_safe_join(fresh, held, [*keys, cursor], "left_anti")


def high_water_mark(df: DataFrame, cursor: str):
    """Largest cursor value (one row)."""
    return df.agg(F.max(cursor)).first()[0]


def store_mark(pulled: DataFrame, cursor: str, path: str) -> None:
    """Add the high-water mark of a pull to the control table at ``path``, one table per source.

    Marks are only ever added and the largest one counts, so a repeated or late run does no harm.
    """
    pulled.agg(F.max(cursor).alias("mark")).filter(F.col("mark").isNotNull()).write.mode("append").parquet(path)


def stored_mark(spark: SparkSession, path: str):
    """The mark to pull from, None before the first pull."""
    if not path_exists(spark, path):
        return None
    return high_water_mark(spark.read.parquet(path), "mark")
