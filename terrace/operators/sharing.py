"""Data handed to recipients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.layout import write_partitioned
from terrace.plans.joins import any_of


def build_share(df: DataFrame, columns: list[str], predicate: Column | None = None) -> DataFrame:
    """The rows and columns one recipient gets."""
    rows = df if predicate is None else df.filter(predicate)
    return rows.select(*columns)


def share_by_recipient(df: DataFrame, entitlements: DataFrame, on: list[str]) -> DataFrame:
    """Rows for all recipients in one pass; entitlements listed twice count once."""
    return df.join(entitlements.select("recipient", *on).distinct(), on)


def write_shares(shared: DataFrame, path: str) -> None:
    write_partitioned(shared, path, ["recipient"])


def share_usage(grants: DataFrame, reads: DataFrame, on: list[str]) -> DataFrame:
    """(finding, on): ``ungranted_read`` for reads without a grant, ``unused_grant`` for the reverse.

    NULL equals nothing, so a read and a grant that hold one are both found. Both sides are counted
    off in one aggregate, which a task holds once: joins would keep and sort each side twice.
    """
    seen = grants.select(*on, F.lit(1).alias("__side")).unionByName(reads.select(*on, F.lit(2).alias("__side")))
    sides = seen.groupBy(*on).agg(F.bit_or("__side").alias("__sides"))
    unknown = any_of([F.col(c).isNull() for c in on])
    one_sided = F.when(F.col("__sides") == 1, F.array(F.lit("unused_grant"))).when(F.col("__sides") == 2, F.array(F.lit("ungranted_read")))
    found = one_sided.when(unknown, F.array(F.lit("ungranted_read"), F.lit("unused_grant")))
    return sides.select(F.explode(found).alias("finding"), *on)
