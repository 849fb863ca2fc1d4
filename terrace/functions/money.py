"""Exact money: integer cents or decimals, never sums of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: str | Column) -> Column:
    """Amount in whole cents; rounds first because a cast would truncate."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.round(c * 100).cast("bigint")


def discounted(price: str, discount: str) -> Column:
    """price * (1 - discount) in units of 1/10,000, exact for two-digit inputs."""
    return cents(price) * (F.lit(100) - cents(discount))


def from_units(total: Column) -> Column:
    """Sum of :func:`discounted` units as an amount; the sum is a decimal, so it cannot overflow."""
    return (F.sum(total.cast("decimal(20,0)")) / 10_000).cast("double")
