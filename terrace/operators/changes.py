"""Change application: current state and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.operators.refine import dedupe_latest
from terrace.plans.chunks import CHUNK, HOT_ROWS, KEY, neighbour, tag_chunks
from terrace.plans.joins import null_safe_join

GONE = "_deleted"


def merge_changes(state: DataFrame | None, changes: DataFrame, keys: list[str], seq: list[str], delete_when: Column) -> DataFrame:
    """Newest change per key, deletes kept as rows with ``_deleted`` so that late changes cannot revive them."""
    fresh = changes.withColumn(GONE, F.coalesce(delete_when, F.lit(False)))
    rows = fresh if state is None else state.unionByName(fresh)
    return dedupe_latest(rows, keys, [F.col(s).desc() for s in seq])


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter(~F.col(GONE)).drop(GONE)


def apply_changes_scd1(target: DataFrame | None, changes: DataFrame, keys: list[str], seq: list[str], delete_when: Column) -> DataFrame:
    """Latest live row per key after the changes. ``seq`` is a total order; replaying changes nothing."""
    if target is not None and GONE not in target.columns:
        target = target.withColumn(GONE, F.lit(False))
    return live_rows(merge_changes(target, changes, keys, seq, delete_when))


def history_from_changes(
    changes: DataFrame,
    keys: list[str],
    seq: list[str],
    delete_when: Column,
    track: list[str],
    chunk: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows ``keys, track, seq[1:], valid_from, valid_to`` with half-open ranges, NULL = still open.

    ``seq[0]`` is the event time, the rest break ties: the last change of an instant wins. Runs of
    equal tracked values collapse into one row; a delete closes the row and opens none. A change
    without a time comes before all others. ``chunk`` (default: quantiles) follows ``seq[0]``
    (see ``terrace.plans.chunks``).
    """
    when = seq[0]
    rows = changes.select(*keys, *track, *seq, F.coalesce(delete_when, F.lit(False)).alias(GONE))
    rows = tag_chunks(rows, keys, when, chunk, hot_rows)
    # one row per instant: rows of an instant share a chunk, so its last row has another instant next
    rank = Window.partitionBy(KEY, CHUNK).orderBy(when, *seq[1:], F.col(GONE).desc())
    rows = rows.withColumn("__next", F.lead(F.struct(F.col(when).alias("t"))).over(rank))
    rows = rows.filter(F.col("__next").isNull() | ~F.col("__next.t").eqNullSafe(F.col(when))).drop("__next")
    was = {f"__p_{c}": F.col(c) for c in track}
    rows = neighbour(rows, [when], {**was, "__p_gone": F.col(GONE)})
    same = F.col(GONE) == F.col("__p_gone")
    for c in track:
        same = same & (F.col(GONE) | F.col(c).eqNullSafe(F.col(f"__p_{c}")))
    starts = rows.filter(F.col("__p_gone").isNull() | ~same).drop(*was, "__p_gone")
    closed = neighbour(starts, [when], {"valid_to": F.col(when)}, forward=True)
    return closed.filter(~F.col(GONE)).select(
        *keys, *track, *seq[1:], F.col(when).alias("valid_from"), "valid_to"
    )


def apply_changes_scd2(
    target: DataFrame | None,
    changes: DataFrame,
    keys: list[str],
    seq: list[str],
    delete_when: Column,
    track: list[str],
    chunk: Column | None = None,
    hot_rows: int = HOT_ROWS,
    log: DataFrame | None = None,
) -> DataFrame:
    """History after ``changes``; only keys that occur in the changes are rebuilt.

    With ``log``, the table of all earlier changes, those keys are replayed from it, which is
    exact for any late change. Without it their history rows are turned back into changes (an
    opening and, where closed, a closing one): late changes still split rows, but repeats that
    had collapsed into a row are no longer known. ``chunk`` has to be written over ``seq[0]``.
    """
    if target is None:
        return history_from_changes(changes, keys, seq, delete_when, track, chunk, hot_rows)
    when = seq[0]
    touched = changes.select(*keys).distinct()
    untouched = null_safe_join(target, touched, keys, "left_anti")
    if log is not None:
        earlier = null_safe_join(log, touched, keys, "left_semi").select(*changes.columns)
        replayed = earlier.unionByName(changes)
        rebuilt = history_from_changes(replayed, keys, seq, delete_when, track, chunk, hot_rows)
        return untouched.unionByName(rebuilt)
    affected = null_safe_join(target, touched, keys, "left_semi")
    opening = affected.select(*keys, *track, *seq[1:], F.col("valid_from").alias(when), F.lit(False).alias(GONE))
    # a closing change ranks below any real change of the same instant
    lowest = [F.lit(None).cast(affected.schema[s].dataType).alias(s) for s in seq[1:]]
    blank = [F.lit(None).cast(affected.schema[c].dataType).alias(c) for c in track]
    closing = affected.filter(F.col("valid_to").isNotNull()).select(
        *keys, *blank, *lowest, F.col("valid_to").alias(when), F.lit(True).alias(GONE)
    )
    fresh = changes.select(*keys, *track, *seq, F.coalesce(delete_when, F.lit(False)).alias(GONE))
    replayed = opening.unionByName(closing).unionByName(fresh)
    rebuilt = history_from_changes(replayed, keys, seq, F.col(GONE), track, chunk, hot_rows)
    return untouched.unionByName(rebuilt)
