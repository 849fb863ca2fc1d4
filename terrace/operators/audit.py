"""Audit-log analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.times import day_of, micros, time_slot
from terrace.plans.chunks import HOT_ROWS, last_known, neighbour, running_total, tag_chunks, untag
from terrace.plans.joins import all_of, null_safe_join

BAD = "_bad_payload"


def parse_audit(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Typed columns from a JSON payload; a payload that does not parse is kept in ``_bad_payload``."""
    full = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = df.withColumn("__p", F.from_json(F.col(col), full, options))
    rest = [c for c in df.columns if c != col]
    return parsed.select(*rest, *[F.col("__p")[n].alias(n) for n in full.fieldNames()])


def activity_windows(
    df: DataFrame, time: str, size: str, keys: list[str], slide: str | None = None, watermark: str | None = None
) -> DataFrame:
    """Counts per tumbling or sliding window and key, batch or stream."""
    rows = df.withWatermark(time, watermark) if watermark else df
    window = F.window(time, size, slide) if slide else F.window(time, size)
    counted = rows.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


def sessionize(
    df: DataFrame,
    time: str,
    gap_seconds: int,
    keys: list[str],
    chunk: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``session_no`` (1, 2, ... per key); a pause longer than the gap starts a new session.

    A pause of exactly the gap does not. Rows without a time come first, each a session of its own.
    ``chunk`` (default: quantiles) splits keys with more than ``hot_rows`` rows.
    """
    rows = neighbour(tag_chunks(df, keys, time, chunk, hot_rows), [time], {"__last": F.col(time)})
    pause = micros(time) - micros("__last")
    goes_on = F.col("__last").isNotNull() & (pause <= gap_seconds * 1_000_000)
    # rows of one instant come in any order, so the one that starts the session is counted first
    rows = rows.withColumn("__on", F.when(goes_on, 1).otherwise(0).cast("bigint")).drop("__last")
    return untag(running_total(rows, [time, "__on"], 1 - F.col("__on"), "session_no")).drop("__on")


def session_totals(sessions: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """(keys, session_no, started, ended, n) of sessionized rows."""
    return sessions.groupBy(*keys, "session_no").agg(
        F.min(time).alias("started"), F.max(time).alias("ended"), F.count(F.lit(1)).alias("n")
    )


def session_windows(df: DataFrame, time: str, gap_seconds: int, keys: list[str], watermark: str | None = None) -> DataFrame:
    """(keys, started, ended, n); ``ended`` is the last event plus the gap.

    A stream uses ``session_window``. That would sort a whole key in one task in batch, so batch
    goes through :func:`sessionize`, with the same result.
    """
    if not df.isStreaming:
        totals = session_totals(sessionize(df.select(*keys, time), time, gap_seconds, keys), time, keys)
        ended = F.col("ended") + F.expr(f"INTERVAL {gap_seconds} SECONDS")
        return totals.select(*keys, "started", ended.alias("ended"), "n")
    rows = df.withWatermark(time, watermark) if watermark else df
    window = F.session_window(time, f"{gap_seconds} seconds")
    counted = rows.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


def detect_bursts(
    df: DataFrame, time: str, cond: Column, n: int, span_seconds: int, keys: list[str], weight: Column | None = None
) -> DataFrame:
    """(keys, time, n_here, n_in_span): instants at which at least ``n`` matching events lie in the
    span that ends there, both ends included. A row stands for ``weight`` events (default: one).

    Events of one key and instant are counted first. Instants are then cut into slots one span
    wide; a copy in the next slot lets the window of a slot see back a whole span. A hot key
    thus spreads over its slots, and rows at most double.
    """
    events = F.count(F.lit(1)) if weight is None else F.sum(weight)
    instants = df.filter(cond).groupBy(*keys, time).agg(events.alias("n_here"))
    own = instants.select("*", micros(time).alias("__us"), time_slot(time, span_seconds).alias("__own"))
    seen = own.withColumn("__slot", F.explode(F.array(F.col("__own"), F.col("__own") + 1)))
    back = Window.partitionBy(*keys, "__slot").orderBy("__us").rangeBetween(-span_seconds * 1_000_000, 0)
    counted = seen.withColumn("n_in_span", F.sum("n_here").over(back))
    return counted.filter((F.col("__slot") == F.col("__own")) & (F.col("n_in_span") >= n)).select(
        *keys, time, "n_here", "n_in_span"
    )


def first_seen(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """First time per key, batch or stream (update or complete mode)."""
    return df.groupBy(*keys).agg(F.min(time).alias("first_seen"))


PER_TASK_LIMIT = 1000  # Spark cuts groups before the shuffle up to this rank


def top_k(df: DataFrame, group: list[str], by: list[Column | str], k: int, spread: int = 256) -> DataFrame:
    """First ``k`` rows per group under a total order, with ``rank``.

    Spark cuts every map partition to ``k`` rows per group before the shuffle. It does so for
    small ``k`` only; for a larger one the group is first ranked in ``spread`` parts.
    """
    if k > PER_TASK_LIMIT:
        # any spread will do, since the order is total; a row number takes columns of every type
        part = F.pmod(F.monotonically_increasing_id(), F.lit(spread))
        pieces = df.withColumn("__part", part)
        w = Window.partitionBy(*group, "__part").orderBy(*by)
        df = pieces.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k).drop("__part", "__r")
    w = Window.partitionBy(*group).orderBy(*by)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def frequent_values(df: DataFrame, col: str, group: list[str], k: int, method: str = "exact", tracked: int = 10_000) -> DataFrame:
    """(group, rank, value, n): most frequent values, equal counts by the value.

    ``method="sketch"`` trades exact counts for a bounded state: they are estimates where a group has
    more than ``tracked`` distinct values, and the order of equals is open.
    """
    if method == "exact":
        counted = df.groupBy(*group, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        return top_k(counted, group, [F.desc("n"), F.asc_nulls_last("value")], k).select(*group, "rank", "value", "n")
    if method != "sketch":
        raise ValueError(f"unknown method {method}")
    found = df.groupBy(*group).agg(F.expr(f"approx_top_k({col}, {int(k)}, {int(tracked)})").alias("top"))
    listed = found.select(*group, F.posexplode("top").alias("pos", "t"))
    return listed.select(*group, (F.col("pos") + 1).alias("rank"), F.col("t.item").alias("value"), F.col("t.count").alias("n"))


def access_matrix(df: DataFrame, row: list[str], col: str, values: list, measure: Column | None = None) -> DataFrame:
    """Cross-tab with one column per given value, 0 where nothing happened."""
    agg = F.count(F.lit(1)) if measure is None else measure
    return df.groupBy(*row).pivot(col, values).agg(agg).na.fill(0)


def distinct_users(df: DataFrame, user: str, keys: list[str], method: str = "exact", rsd: float = 0.05) -> DataFrame:
    """Reach per key: ``exact``, ``approximate``, or a mergeable ``sketch``."""
    if method == "exact":
        # distinct pairs are reduced map-side and spread by (key, user): no task holds a whole key
        pairs = df.filter(F.col(user).isNotNull()).groupBy(*keys, user).agg(F.lit(1).alias("__one"))
        return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("users"))
    if method == "approximate":
        return df.groupBy(*keys).agg(F.approx_count_distinct(user, rsd).alias("users"))
    if method == "sketch":
        return df.groupBy(*keys).agg(F.hll_sketch_agg(user).alias("users"))
    raise ValueError(f"unknown method {method!r}")


def daily_reach(df: DataFrame, time: str, user: str, keys: list[str], watermark: str | None = None) -> DataFrame:
    """(day_start, keys, users): a mergeable sketch for each day, so a stream's state ends with the day."""
    rows = df.withWatermark(time, watermark) if watermark else df
    days = rows.groupBy(F.window(time, "1 day").alias("w"), *keys).agg(F.hll_sketch_agg(user).alias("users"))
    return days.select(F.col("w.start").alias("day_start"), *keys, "users")


def reach_of_days(days: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, users) estimated over the days given, from :func:`daily_reach`."""
    return days.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


def distribution(
    df: DataFrame, col: str, keys: list[str], qs: list[float], exact: bool = True,
    chunk: Column | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(keys, q, value): interpolated percentiles, or ``percentile_approx`` when not exact.

    The exact form counts equal values first, then walks the counts in value order; a key with
    more than ``hot_rows`` distinct values is cut by ``chunk`` (default: quantiles). NaN is the largest value.
    """
    if not exact:
        marks = F.array(*[F.lit(q) for q in qs])
        wide = df.groupBy(*keys).agg(F.percentile_approx(col, qs, 10_000).alias("v"))
        pairs = F.arrays_zip(marks.alias("q"), F.col("v").alias("value"))
        return wide.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.q", "p.value")
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    walked = running_total(tag_chunks(counts, keys, col, chunk, hot_rows), [col], F.col("__n"), "__upto")
    walked = untag(walked)
    totals = df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("__total"))
    wanted = totals.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    pos = F.col("q") * (F.col("__total") - 1)
    wanted = wanted.select(
        *keys, "q", pos.alias("__pos"), F.floor(pos).alias("__lo"), F.ceil(pos).alias("__hi")
    )
    # few target ranks per key meet the counted values; only values that hold a rank survive
    start = F.col("__upto") - F.col("__n")

    def holds(rank: str) -> Column:
        return (start <= F.col(rank)) & (F.col(rank) < F.col("__upto"))

    hit = null_safe_join(walked, wanted, keys).filter(holds("__lo") | holds("__hi"))
    ends = hit.groupBy(*keys, "q").agg(
        F.max("__pos").alias("p"), F.max("__lo").alias("lo"),
        F.min(F.when(holds("__lo"), F.col(col))).alias("a"), F.max(F.when(holds("__hi"), F.col(col))).alias("b"),
    )
    return ends.select(*keys, "q", (F.col("a") + (F.col("b") - F.col("a")) * (F.col("p") - F.col("lo"))).alias("value"))


def verify_access(
    access_log: DataFrame, grant_history: DataFrame, keys: list[str], time: str,
    chunk: Column | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The log with ``granted_at`` and ``allowed``: was a grant ``[valid_from, valid_to)`` in force then?

    Grants of a key must not overlap (a result of the history operator does not). Both sides are
    merged in time order and the latest grant is carried forward, so the work is linear even for
    a key with very many accesses and grants. A NULL key grants nothing, nor
    does a NULL time or start. ``chunk`` is written over ``__t``. A stream of accesses is joined to the
    stored history instead.
    """
    if access_log.isStreaming:
        held = grant_history.select(*[F.col(k).alias(f"__{k}") for k in keys], "valid_from", "valid_to")
        at, open_end = F.col(time).cast("timestamp_ntz"), F.col("valid_to").isNull()
        inside = (at >= F.col("valid_from")) & (open_end | (at < F.col("valid_to")))
        joined = access_log.join(held, all_of([*[F.col(k) == F.col(f"__{k}") for k in keys], inside]), "left")
        granted = F.col("valid_from")
        return joined.select(*access_log.columns, granted.isNotNull().alias("allowed"), granted.alias("granted_at"))
    payload = [c for c in access_log.columns if c not in keys]
    row = F.struct(*payload)
    grant = F.struct("valid_from", "valid_to")
    uses = access_log.select(*keys, F.col(time).alias("__t"), F.lit(1).alias("__kind"), row.alias("__row"))
    blank = F.lit(None).cast(grant_history.select(grant.alias("g")).schema["g"].dataType)
    uses = uses.withColumn("__grant", blank)
    opens = grant_history.select(
        *keys, F.col("valid_from").alias("__t"), F.lit(0).alias("__kind"),
        F.lit(None).cast(uses.schema["__row"].dataType).alias("__row"), grant.alias("__grant"),
    )
    both = tag_chunks(uses.unionByName(opens), keys, "__t", chunk, hot_rows)
    merged = last_known(both, ["__t", "__kind"], F.col("__grant"), "__g")
    valid = F.col("__g.valid_to").isNull() | (F.col("__t") < F.col("__g.valid_to"))
    known = all_of([F.col(k).isNotNull() for k in [*keys, "__t", "__g.valid_from"]])
    allowed = F.coalesce(F.col("__g").isNotNull() & valid & known, F.lit(False))
    return merged.filter("__kind = 1").select(
        *keys, "__row.*", allowed.alias("allowed"), F.when(allowed, F.col("__g.valid_from")).alias("granted_at")
    )


def anomalies(daily: DataFrame, time: str, value: str, keys: list[str], n: int) -> DataFrame:
    """Each value against the previous ``n`` rows of its key: mean, sample deviation, z-score.

    Input is one row per key and period (see :func:`fill_gaps`), so a key is as long as the
    calendar and not as the log.
    """
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(-n, -1)
    v = F.col(value).cast("double")
    out = daily.withColumn("mean", F.avg(v).over(w)).withColumn("sd", F.stddev_samp(v).over(w))
    return out.withColumn("z", F.when(F.col("sd") > 0, (v - F.col("mean")) / F.col("sd")))


def fill_gaps(df: DataFrame, time: str, keys: list[str], start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(keys, day, n) with zero rows for silent days between ``start`` and ``end`` (default: the log's).

    There is a row for each key and day, so this is for few keys: :func:`silent_ranges` has one for each gap.
    """
    counted = df.groupBy(*keys, day_of(time).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    ends = counted.agg(F.struct(F.min("day").alias("low"), F.max("day").alias("high"))).scalar()
    low = ends["low"] if start is None else start
    high = ends["high"] if end is None else end
    days = F.sequence(low.cast("date"), high.cast("date"))
    calendar = counted.select(*keys).distinct().select(*keys, F.explode(days).alias("day"))
    calendar = calendar.withColumn("day", F.col("day").cast("timestamp_ntz"))
    return null_safe_join(calendar, counted, [*keys, "day"], "left").na.fill(0, ["n"])


def silent_ranges(df: DataFrame, time: str, keys: list[str], start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(keys, first_day, last_day, days): the runs of days without a row between ``start`` and ``end`` (default: the log's).

    A key has a run at most for each day that it has rows, and one ahead, so the result grows with the log
    and not with keys times days. NULL keys are a key; rows without a time count for no day.
    """
    present = df.filter(F.col(time).isNotNull()).select(*keys, day_of(time).cast("date").alias("__day")).distinct()
    ends = present.agg(F.struct(F.min("__day").alias("low"), F.max("__day").alias("high"))).scalar()
    low = ends["low"] if start is None else start.cast("date")
    high = ends["high"] if end is None else end.cast("date")
    dated = present.select(*keys, "__day", low.alias("__low"), high.alias("__high"))
    inside = dated.filter(F.col("__day").between(F.col("__low"), F.col("__high")))
    w = Window.partitionBy(*keys).orderBy("__day")
    around = inside.withColumns({"__next": F.coalesce(F.lead("__day").over(w), F.date_add("__high", 1)), "__at": F.row_number().over(w)})
    ahead = F.when(F.col("__at") == 1, F.struct(F.col("__low").alias("first_day"), F.date_sub("__day", 1).alias("last_day")))
    behind = F.struct(F.date_add("__day", 1).alias("first_day"), F.date_sub("__next", 1).alias("last_day"))
    runs = around.select(*keys, F.explode(F.array_compact(F.array(ahead, behind))).alias("run")).select(*keys, "run.*")
    # a key whose days all lie outside is silent throughout
    outside = dated.select(*keys, F.col("__low").alias("first_day"), F.col("__high").alias("last_day")).distinct()
    outside = null_safe_join(outside, inside.select(*keys).distinct(), keys, "left_anti")
    return runs.unionByName(outside).filter("first_day <= last_day").withColumn("days", F.datediff("last_day", "first_day") + 1)


def freshness(df: DataFrame, keys: list[str], time: str, now: Column) -> DataFrame:
    """(keys, last_seen, silent_seconds)."""
    last = df.groupBy(*keys).agg(F.max(time).alias("last_seen"))
    silent = F.floor((micros(now) - micros("last_seen")) / 1_000_000).cast("bigint")
    return last.withColumn("silent_seconds", silent)
