"""Join shapes used by several operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the left key columns are kept."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def all_of(conditions: list[Column]) -> Column:
    return reduce(Column.__and__, conditions) if conditions else F.lit(True)


def any_of(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions) if conditions else F.lit(False)
