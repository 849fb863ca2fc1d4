"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    seconds = (_col(c).cast("timestamp_ntz") - epoch).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def time_slot(c: str | Column, width_seconds: int) -> Column:
    """Number of the fixed-width slot that holds the timestamp; grows with time."""
    return F.floor(micros(c) / F.lit(width_seconds * 1_000_000)).cast("bigint")


def day_of(c: str | Column) -> Column:
    """Midnight of the day as a wall-clock timestamp."""
    return _col(c).cast("date").cast("timestamp_ntz")


def month_of(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "month").cast("timestamp_ntz")


def year_of(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "year").cast("timestamp_ntz")


def before(c: str | Column, day: str) -> Column:
    """Whether the timestamp lies ahead of the day, as a range that reaches the file scan."""
    return _col(c) < F.lit(day).cast("timestamp_ntz")
