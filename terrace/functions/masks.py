"""Column masks. Name and type of the column stay, except that a hash is text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Masks from the most to the least restrictive.
RESTRICTIVENESS = ["null", "redact", "hash", "partial", "bucket", "none"]

Mask = Callable[[Column, T.DataType], Column]


def null() -> Mask:
    return lambda c, t: F.lit(None).cast(t)


def redact() -> Mask:
    """A constant of the same type; types without a neutral constant become NULL."""

    def apply(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.StringType):
            return F.when(c.isNotNull(), F.lit("REDACTED"))
        if isinstance(t, T.NumericType):
            return F.when(c.isNotNull(), F.lit(0).cast(t))
        return F.lit(None).cast(t)

    return apply


def letters() -> Mask:
    """Keep the shape: capitals X, small letters x, digits n."""
    return lambda c, t: F.mask(c)


def partial(keep: int = 4) -> Mask:
    """Only the last ``keep`` characters stay; shorter values vanish altogether. Text only, else redact."""

    def apply(c: Column, t: T.DataType) -> Column:
        if not isinstance(t, T.StringType):
            return redact()(c, t)
        hidden = F.greatest(F.length(c) - keep, F.lit(0))
        shown = F.when(F.length(c) > keep, F.substring(c, -keep, keep)).otherwise("")
        return F.concat(F.repeat(F.lit("*"), F.when(F.length(c) > keep, hidden).otherwise(F.length(c))), shown)

    return apply


def hashed(salt: str = "") -> Mask:
    return lambda c, t: F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)


def bucket(width: int) -> Mask:
    """Numbers down to a multiple of ``width``; other types are redacted."""
    return lambda c, t: (F.floor(c / width) * width).cast(t) if isinstance(t, T.NumericType) else redact()(c, t)


def year_only() -> Mask:
    """Dates and times down to their year; other types are redacted."""
    timed = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return lambda c, t: F.trunc(c.cast("date"), "year").cast(t) if isinstance(t, timed) else redact()(c, t)


def by_name(name: str, **options) -> Mask:
    """The mask for a name of ``RESTRICTIVENESS``; used when policies are data."""
    made = {
        "null": lambda: null(),
        "redact": lambda: redact(),
        "hash": lambda: hashed(options.get("salt", "")),
        "partial": lambda: partial(options.get("keep", 4)),
        "bucket": lambda: bucket(options.get("width", 1000)),
        "none": lambda: (lambda c, t: c),
    }
    return made[name]()
