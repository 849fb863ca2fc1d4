"""Ordered look-back and look-ahead per key that survives a key holding a third of the rows.

A plain ``Window.partitionBy(key)`` sorts a whole key in one task. Here the rows of a hot key
are cut into chunks along the leading order column: the window runs per ``(key, chunk)``, one
summary row per chunk is reduced map-side, a second window runs over those summaries only, and
its result is joined back on ``(key, chunk)``, the partitioning the rows already have.

Cold keys form one chunk (NULL) and take the plain path. When no key is hot, AQE sees the empty
list of hot keys and drops the cuts, the summary branch, its scan and the join. Several steps over
one tagged frame share one shuffle and one count of the keys.

The cut only places rows in tasks, the result is the same for every one. Keys and chunks travel
as structs, so that a NULL key is a key and a NULL or NaN order value has its place (NULL first,
NaN last) like in a plain window. By default a hot key is cut at its own quantiles; a given
``chunk`` must never decrease along the order, NULL counting as lowest. Rows of one key and one
value of the order column stay together.

A key is hot when it has more than ``hot_rows`` rows and more than one ``HOT_KEYS``-th of all
rows. So at most ``HOT_KEYS`` keys are listed, each with 270 cuts (22 MB and the keys), which
bounds the broadcast. The broadcast is needed: a shuffled join would leave all rows of a hot key
in one partition, and the windows would take that partitioning as good enough. Input that is
already hash-partitioned by its keys (a join or aggregate on them) would stay so: write it out first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 5_000_000
HOT_KEYS = 10_000
KEY, CHUNK = "__key", "__chunk"
#: A hot key is cut into ``STEP * STEP`` chunks, found in two steps of ``STEP`` comparisons.
STEP = 16


def _matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join by plain equality, which lets Spark keep the partitioning of ``left``."""
    renamed = right.withColumnsRenamed({k: f"__m_{k}" for k in on})
    same = reduce(Column.__and__, [F.col(k) == F.col(f"__m_{k}") for k in on])
    return left.join(renamed, same, "left").drop(*[f"__m_{k}" for k in on])


def with_chunk(df: DataFrame, keys: list[str], chunk: Column) -> DataFrame:
    """Add the key and a chunk column of the caller's own: NULL for rows that need no cut."""
    return df.withColumns({KEY: F.struct(*keys), CHUNK: chunk})


def _hot_keys(keyed: DataFrame, hot_rows: int) -> DataFrame:
    counted = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("__n"))
    share = counted.agg(F.sum("__n") / HOT_KEYS).scalar()
    return counted.filter((F.col("__n") > hot_rows) & (F.col("__n") > share)).select(KEY)


def _quantiles(keyed: DataFrame, hot: DataFrame, order: str) -> DataFrame:
    """(key, coarse, fine): all cuts of a hot key in ascending order, and every ``STEP``-th of them."""
    pieces = STEP * STEP
    renamed = F.broadcast(hot.withColumnRenamed(KEY, "__hot_key"))
    rows = keyed.join(renamed, F.col(KEY) == F.col("__hot_key"), "left_semi")
    marks = [i / pieces for i in range(1, pieces)]
    cuts = rows.groupBy(KEY).agg(F.percentile_approx(order, marks, 4 * pieces).alias("__fine"))
    every = F.sequence(F.lit(STEP), F.lit(pieces - 1), F.lit(STEP))
    return cuts.withColumn("__coarse", F.transform(every, lambda i: F.element_at("__fine", i)))


def tag_chunks(df: DataFrame, keys: list[str], order: str, chunk: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add the key and the chunk: a place along ``order`` for rows of hot keys, NULL for all others.

    Numbers, dates and timestamps are cut at quantiles; an ``order`` of another type is cut by
    ``chunk`` only, and not at all without one.
    """
    keyed = df.withColumn(KEY, F.struct(*keys))
    hot = _hot_keys(keyed, hot_rows)
    cut_type = isinstance(df.schema[order].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
    if chunk is None and cut_type:
        listed = _quantiles(keyed, hot, order)
        value = F.col(order)
        coarse = F.size(F.filter("__coarse", lambda cut: cut <= value))
        part = F.slice("__fine", coarse * STEP + 1, STEP - 1)
        place = F.struct(coarse.alias("a"), F.size(F.filter(part, lambda cut: cut <= value)).alias("b"))
    else:
        listed, place = hot, F.struct((F.lit(None).cast("int") if chunk is None else chunk).alias("a"))
    listed = listed.withColumn("__hot", F.lit(True))
    tagged = _matched(keyed, F.broadcast(listed), [KEY]).withColumn(CHUNK, F.when(F.col("__hot"), place))
    return tagged.select(*df.columns, KEY, CHUNK)


def untag(tagged: DataFrame) -> DataFrame:
    return tagged.drop(KEY, CHUNK)


def _within(order: list[str]) -> Window:
    return Window.partitionBy(KEY, CHUNK).orderBy(*order)


def _along() -> Window:
    return Window.partitionBy(KEY).orderBy(CHUNK)


def _carried(tagged: DataFrame, source: DataFrame, summary: Column, carry: Column, name: str) -> DataFrame:
    """Reduce each chunk of a hot key to ``__edge``, evaluate ``carry`` over the chunks, join it back."""
    chunks = source.filter(F.col(CHUNK).isNotNull()).groupBy(KEY, CHUNK).agg(summary.alias("__edge"))
    return _matched(tagged, chunks.select(KEY, CHUNK, carry.alias(name)), [KEY, CHUNK])


def neighbour(tagged: DataFrame, order: list[str], values: dict[str, Column], forward: bool = False) -> DataFrame:
    """``lag(1)`` (or ``lead(1)`` when ``forward``) of ``values`` along an ascending total order."""
    row = F.struct(*[c.alias(n) for n, c in values.items()])
    edge, step = (F.min_by, F.lead) if forward else (F.max_by, F.lag)
    out = tagged.withColumn("__near", step(row, 1).over(_within(order)))
    out = _carried(out, tagged, edge(row, F.struct(*order)), step("__edge", 1).over(_along()), "__far")
    out = out.withColumn("__found", F.coalesce("__near", "__far"))
    return out.select(*tagged.columns, *[F.col("__found")[n].alias(n) for n in values])


def running_total(tagged: DataFrame, order: list[str], value: Column, out_name: str) -> DataFrame:
    """Inclusive running sum of an integer value along an ascending total order."""
    here = F.sum(value).over(_within(order).rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum("__edge").over(_along().rowsBetween(Window.unboundedPreceding, -1))
    out = _carried(tagged.withColumn("__here", here), tagged, F.sum(value), before, "__before")
    total = F.coalesce("__here", F.lit(0)) + F.coalesce("__before", F.lit(0))
    return out.select(*tagged.columns, total.alias(out_name))


def last_known(tagged: DataFrame, order: list[str], value: Column, out_name: str) -> DataFrame:
    """Latest non-NULL ``value`` at or before each row along an ascending total order."""
    here = F.last(value, ignorenulls=True).over(_within(order).rowsBetween(Window.unboundedPreceding, 0))
    latest = F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    before = F.last("__edge", ignorenulls=True).over(_along().rowsBetween(Window.unboundedPreceding, -1))
    out = _carried(tagged.withColumn("__here", here), tagged, latest, before, "__before")
    return out.select(*tagged.columns, F.coalesce("__here", "__before").alias(out_name))
